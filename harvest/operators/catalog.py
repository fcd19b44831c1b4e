"""Catalog operators: S08/A01/J05 counts, J06/P04/O02/R03 listing, P06 lookup,
P07/P08 search, P09 row search, J04 reconcile, P10 orphans, K12 re-key,
K13/J12 cascading delete, K11 key checks, J03 related files, J13 title->file.

The catalog is the ``metadata_index`` table: one row per dataset, keyed by
``dataset_id``. Dataset rows of all datasets live in one table partitioned by
``dataset_id``; the list of existing tables is a DataFrame of names (from
``spark.catalog.listTables`` or a directory listing).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvest.functions.text import (PDF_STRIP_CHAR, PROCESSED_SUFFIX, clean_keyword,
                                    clean_table_name, is_processed, strip_processed)
from harvest.operators.joins import contains_join

def catalog_counts(catalog: DataFrame, rows: DataFrame, id_col: str = "dataset_id",
                   fk_col: str = "dataset_id", name: str = "row_count") -> DataFrame:
    """Every catalog row with its row count (0 when none).
    One aggregate over all dataset rows instead of one COUNT per table."""
    counts = rows.groupBy(F.col(fk_col).alias("_fk")).agg(F.count(F.lit(1)).alias(name))
    j = catalog.join(counts, catalog[id_col] == counts["_fk"], "left").drop("_fk")
    return j.withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))


def with_totals(catalog: DataFrame, totals: DataFrame, id_col: str = "dataset_id") -> DataFrame:
    """Every catalog row with ``row_count`` and ``max_seq`` from a store's running totals
    (``Store.totals``), 0 for datasets without rows. No dataset row is read."""
    t = totals.select(F.col("dataset_id").alias("_fk"), "row_count", "max_seq")
    zero = F.lit(0).cast("bigint")
    j = catalog.join(t, catalog[id_col] == t["_fk"], "left")
    return j.select(*[catalog[c] for c in catalog.columns], F.coalesce("row_count", zero).alias("row_count"), F.coalesce("max_seq", zero).alias("max_seq"))


def catalog_listing(catalog: DataFrame, processed_ids: DataFrame, id_col: str = "dataset_id",
                    columns: Sequence[str] = ("title", "category", "dataset_id", "row_count"),
                    flag: str = "has_processed") -> DataFrame:
    """Chosen columns plus a has-processed flag, ordered by id."""
    p = processed_ids.select(F.col(processed_ids.columns[0]).alias("_pid")).distinct()
    j = catalog.join(p, catalog[id_col] == p["_pid"], "left")
    return j.select(*columns, F.col("_pid").isNotNull().alias(flag)).orderBy(id_col)


def catalog_lookup(catalog: DataFrame, idents: DataFrame, ident_col: str = "ident",
                   id_col: str = "dataset_id", title_col: str = "title",
                   ord_col: str = "ord") -> DataFrame:
    """Per identifier, the catalog row with that exact id, else the first
    (by catalog order) whose title contains the identifier; none -> no row."""
    cat = catalog.select(F.col(id_col).alias("_id"), F.col(title_col).alias("_title"),
                         F.col(ord_col).alias("_ord"))
    exact = idents.join(cat, idents[ident_col] == cat["_id"], "inner") \
        .select(ident_col, "_id", F.lit(0).alias("_prio"), "_ord")
    fuzzy = contains_join(cat, "_title", idents.select(ident_col), ident_col) \
        .select(ident_col, "_id", F.lit(1).alias("_prio"), "_ord")
    best = (exact.unionByName(fuzzy).groupBy(ident_col)
            .agg(F.min_by(F.col("_id"), F.struct("_prio", "_ord")).alias(id_col)))
    return best.join(catalog, id_col)


def catalog_search(catalog: DataFrame, keywords: DataFrame, kw_col: str = "keyword",
                   id_col: str = "dataset_id", title_col: str = "title",
                   category_col: str = "category", ord_col: str = "ord") -> DataFrame:
    """Keyword search. The keyword is cleaned (F05). An exact hit (title ==
    keyword or id == keyword) wins and only the first exact hit is returned;
    otherwise every fuzzy hit (title, id or category contains it, lower-case)
    is returned. Empty keywords match nothing."""
    kw = keywords.select(kw_col, clean_keyword(F.col(kw_col)).alias("_kw")).where(F.col("_kw") != "")
    cat = catalog.select(F.col(id_col), F.col(title_col), F.col(category_col), F.col(ord_col),
                         F.lower(F.col(title_col)).alias("_lt"), F.col(id_col).cast("string").alias("_ids"),
                         F.coalesce(F.col(category_col), F.lit("")).alias("_cat"))
    # exact hits are equi-joins; fuzzy hits are substring joins (no cross product)
    values = cat.withColumn("_text", F.explode(F.array("_lt", "_ids", "_cat")))
    parts = [cat.join(kw, cat[title_col] == kw["_kw"]), cat.join(kw, cat["_ids"] == kw["_kw"]), contains_join(values, "_text", kw, "_kw").drop("_text")]
    j = parts[0]
    for p in parts[1:]:
        j = j.unionByName(p)
    j = j.dropDuplicates([kw_col, id_col])
    exact = (F.col(title_col) == F.col("_kw")) | (F.col(id_col).cast("string") == F.col("_kw"))
    j = j.withColumn("_exact", exact)
    firsts = (j.where("_exact").groupBy(kw_col)
              .agg(F.min_by(F.struct(id_col, title_col, category_col), F.col(ord_col)).alias("_hit"))
              .select(kw_col, "_hit.*", F.lit(True).alias("exact")))
    has_exact = firsts.select(kw_col)
    fuzzy = (j.where(~F.col("_exact")).join(has_exact, kw_col, "left_anti")
             .select(kw_col, id_col, title_col, category_col, F.lit(False).alias("exact")))
    return firsts.unionByName(fuzzy)


def category_datasets(catalog: DataFrame, category: str | DataFrame, category_col: str = "category",
                      id_col: str = "dataset_id") -> DataFrame:
    """Datasets of one category, or of those in a one-column frame, ordered by id."""
    if isinstance(category, DataFrame):
        wanted = category.select(F.col(category.columns[0]).alias(category_col))
        return catalog.join(wanted, category_col, "left_semi").orderBy(id_col).select(*catalog.columns)
    return catalog.where(F.col(category_col) == F.lit(category)).orderBy(id_col)


def row_text_search(df: DataFrame, needle: str) -> DataFrame:
    """Rows whose JSON text contains ``needle`` (case-insensitive)."""
    return df.where(F.contains(F.lower(F.to_json(F.struct(*[F.col(c) for c in df.columns]))),
                               F.lower(F.lit(needle))))


DATASET_ID_RE = r"^\d{7,}$"   # dataset ids: 3-digit category prefix + sequence of 4 digits or more


def reconcile(catalog: DataFrame, table_names: DataFrame, id_col: str = "dataset_id",
              title_col: str = "title", name_col: str = "table_name",
              id_pattern: str = DATASET_ID_RE) -> DataFrame:
    """Three-way full outer reconcile of catalog / raw tables / processed
    tables on the dataset id; missing flags are false, missing text is ''.
    Only tables whose dataset id matches ``id_pattern`` count (service tables
    such as the file registry or config tables are not datasets, Q20)."""
    t1 = catalog.select(F.col(id_col).cast("string").alias("_id"), F.col(title_col).alias("title"),
                        F.lit(True).alias("in_catalog"))
    names = (table_names.select(F.col(name_col).alias("_n"))
             .where(strip_processed(F.col("_n")).rlike(id_pattern)))
    t2 = names.where(~is_processed(F.col("_n"))).select(F.col("_n").alias("_id"), F.lit(True).alias("in_raw"))
    t3 = names.where(is_processed(F.col("_n"))).select(
        strip_processed(F.col("_n")).alias("_id"), F.col("_n").alias("processed_name"),
        F.lit(True).alias("in_processed"))
    j = t1.join(t2, "_id", "full").join(t3, "_id", "full")
    return j.select(
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("_id"), F.lit("")).alias(id_col),
        F.coalesce(F.col("processed_name"), F.lit("")).alias("processed_name"),
        F.coalesce(F.col("in_catalog"), F.lit(False)).alias("in_catalog"),
        F.coalesce(F.col("in_raw"), F.lit(False)).alias("in_raw"),
        F.coalesce(F.col("in_processed"), F.lit(False)).alias("in_processed"))


def orphan_entries(reconciled: DataFrame) -> DataFrame:
    """P10: catalog entries with neither a raw nor a processed table."""
    return reconciled.where(F.col("in_catalog") & ~F.col("in_raw") & ~F.col("in_processed"))


def cascade_delete(parent: DataFrame, children: dict[str, tuple[DataFrame, str]],
                   doomed: DataFrame, key: str = "dataset_id") -> dict[str, DataFrame]:
    """Remove the doomed keys from the parent and every child
    (``children``: name -> (frame, foreign-key column)). Returns new versions."""
    d = doomed.select(F.col(key).alias("_k")).distinct()
    out = {"parent": parent.join(d, parent[key] == d["_k"], "left_anti")}
    for name, (df, fk) in children.items():
        out[name] = df.join(d, df[fk] == d["_k"], "left_anti")
    return out


def keep_children_of(parent: DataFrame, child: DataFrame, key: str, fk: str) -> DataFrame:
    """Children whose parent survives (left-semi)."""
    return child.join(parent.select(F.col(key).alias("_k")).distinct(), child[fk] == F.col("_k"), "left_semi")


def rekey(frames: dict[str, tuple[DataFrame, str]], old: str, new: str,
          existing_ids: DataFrame) -> dict[str, DataFrame]:
    """Rename a dataset id everywhere (catalog key and children's foreign
    keys). Refused (inputs returned unchanged) when ``new`` already exists --
    the check is one filtered count on the id column."""
    if old == new or existing_ids.where(F.col(existing_ids.columns[0]) == F.lit(new)).limit(1).count():
        return {n: df for n, (df, _) in frames.items()}
    return {n: df.withColumn(c, F.when(F.col(c) == F.lit(old), F.lit(new)).otherwise(F.col(c)))
            for n, (df, c) in frames.items()}


def key_violations(df: DataFrame, pk: Sequence[str], parent: DataFrame | None = None,
                   fk: str | None = None, parent_key: str | None = None) -> DataFrame:
    """Primary-key and foreign-key checks as queries.

    One row per violation: ``kind`` in (``null_key``, ``duplicate_key``,
    ``orphan``) with the offending key text and how many rows carry it."""
    pk = list(pk)
    ktxt = F.to_json(F.struct(*[F.col(c) for c in pk]))
    nulls = df.where(F.greatest(*[F.col(c).isNull() for c in pk]) if len(pk) > 1 else F.col(pk[0]).isNull())
    out = nulls.groupBy(ktxt.alias("key")).agg(F.count(F.lit(1)).alias("n_rows")) \
        .select(F.lit("null_key").alias("kind"), "key", "n_rows")
    dup = (df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
           .select(F.lit("duplicate_key").alias("kind"), ktxt.alias("key"), "n_rows"))
    out = out.unionByName(dup)
    if parent is not None and fk and parent_key:
        pk_side = parent.select(F.col(parent_key).alias("_pk")).distinct()
        orphan = (df.where(F.col(fk).isNotNull()).join(pk_side, df[fk] == pk_side["_pk"], "left_anti")
                  .groupBy(F.col(fk).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
                  .select(F.lit("orphan").alias("kind"), "key", "n_rows"))
        out = out.unionByName(orphan)
    return out


def related_files(record_files: DataFrame, files: DataFrame, record_ids: DataFrame,
                  file_type: str | None = None) -> DataFrame:
    """Files attached to the given records, optionally of one type."""
    rf = record_files.join(record_ids.select(F.col(record_ids.columns[0]).alias("record_id")).distinct(),
                           "record_id", "left_semi")
    j = rf.join(files, "file_id")
    if file_type:
        j = j.where(F.col("file_type") == F.lit(file_type))
    return j


def title_file_match(titles: DataFrame, files: DataFrame, title_col: str = "title",
                     name_col: str = "file_name", path_col: str = "file_path",
                     suffix: str = ".pdf") -> DataFrame:
    """Per title, the first document file (by name) whose name
    contains the cleaned title (with '圖' removed) or the raw title.

    Both needles of a title go through one substring join (``contains_join``)."""
    f = files.where(F.col(name_col).endswith(suffix)).select(name_col, path_col)
    t = titles.select(title_col, F.replace(clean_table_name(F.col(title_col)), F.lit(PDF_STRIP_CHAR),
                                           F.lit("")).alias("_clean")).distinct()
    needles = t.select(title_col, F.explode(F.array_distinct(F.array("_clean", title_col))).alias("_needle_text"))
    hits = contains_join(f, name_col, needles, "_needle_text")
    best = (t.join(hits.select(title_col, name_col, path_col), title_col, "left")
            .groupBy(title_col, "_clean")
            .agg(F.min_by(F.struct(name_col, path_col), F.col(name_col)).alias("_m")))
    # An empty cleaned title is contained in every name: its match is the first
    # file overall, a scalar subquery evaluated once by Spark.
    first_name = f.agg(F.min(name_col)).scalar()
    first_path = f.agg(F.min_by(path_col, name_col)).scalar()
    empty = F.col("_clean") == ""
    return best.select(title_col, F.when(empty, first_name).otherwise(F.col("_m")[name_col]).alias(name_col),
                       F.when(empty, first_path).otherwise(F.col("_m")[path_col]).alias(path_col))


# ------------------------------------------------------------- table level
# Physical tables of a dataset are named ``ds_<dataset id>`` (an identifier must
# not be all digits for every catalog operation to accept it); the dataset id
# stays the logical key everywhere else.
TABLE_PREFIX = "ds_"


def table_for(dataset_id: str, processed: bool = False) -> str:
    return TABLE_PREFIX + dataset_id + (PROCESSED_SUFFIX if processed else "")


def existing_tables(spark, database: str | None = None) -> DataFrame:
    """Dataset tables that exist (from the session catalog), as names with
    the prefix removed (``<id>`` or ``<id>_processed``), ready for ``reconcile``."""
    names = [t.name for t in spark.catalog.listTables(database)
             if not t.isTemporary and t.name.startswith(TABLE_PREFIX)]
    return spark.createDataFrame([(n[len(TABLE_PREFIX):],) for n in names], "table_name string")


def quoted(name: str) -> str:
    """Backtick-quote a table name (dataset ids are all digits)."""
    return "`" + name.replace("`", "``") + "`"


def table_exists(spark, name: str) -> bool:
    """S07."""
    return spark.catalog.tableExists(quoted(name))


def table_columns(spark, name: str) -> list[str]:
    """S07."""
    return [c.name for c in spark.catalog.listColumns(quoted(name))]


def rename_dataset_tables(spark, old: str, new: str) -> bool:
    """K12 (table level): rename the raw and processed tables of a dataset;
    refused when the new dataset's table already exists."""
    if old == new or table_exists(spark, table_for(new)):
        return False
    for processed in (False, True):
        if table_exists(spark, table_for(old, processed)):
            spark.sql(f"ALTER TABLE {quoted(table_for(old, processed))} RENAME TO {quoted(table_for(new, processed))}")
    return True


def drop_dataset_tables(spark, dataset_id: str, processed_only: bool = False) -> None:
    """K13 (table level): drop the processed table, and the raw table unless
    ``processed_only`` (then the catalog row is kept, Q25)."""
    names = [table_for(dataset_id, True)] + ([] if processed_only else [table_for(dataset_id)])
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(n)}")


def datasets_matching(catalog: DataFrame, ids: DataFrame | None = None, category: str | None = None,
                      keyword: str | None = None, id_col: str = "dataset_id") -> DataFrame:
    """Pick datasets for deletion (K13 by list, by category, by keyword): ids
    given as a DataFrame, every dataset of a category, or the hits of a keyword
    search (an exact hit alone, else every fuzzy hit). Returns distinct ids."""
    parts = []
    if ids is not None:
        parts.append(ids.select(F.col(ids.columns[0]).alias(id_col)))
    if category is not None:
        parts.append(category_datasets(catalog, category).select(id_col))
    if keyword is not None:
        kw = catalog.sparkSession.createDataFrame([(keyword,)], "keyword string")
        parts.append(catalog_search(catalog, kw).select(id_col))
    if not parts:
        return catalog.select(id_col).limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
