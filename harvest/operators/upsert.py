"""One upsert core and its uses: K04 catalog, K05 configs (J07), K06 file
registry (J11 + free ids), K07 insert-if-absent, K09/K15/U04 replace-by-key.

Upsert semantics (K04): for a key present in the batch, every column the batch
supplies overwrites the stored value (NULLs included), other stored columns
are kept, ``created_at`` is kept and ``last_updated_at`` becomes ``now``; a new
key is inserted with both audit columns ``now``. Batch keys are made unique
first (last ordinal wins), matching repeated single-row upserts. A NULL key is
a key like any other, here and in all operators of this module.

Plan shape: stored rows whose key is not in the batch pass through a
left-anti join against the batch keys, and only the batch is left-joined to
the store. With a small batch both joins broadcast the batch (AQE decides by
size) and the store is never shuffled; with a large batch they become
ordinary shuffled joins. The result is meant to be written as a new version
(never over the path being read).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.functions.times import ts_lit
from harvest.functions.sizes import human_size
from harvest.functions.text import file_stem
from harvest.operators.dedup import keep_last
from harvest.operators.ids import allocate, free_intervals
from harvest.operators.joins import same_keys
from harvest.operators.numbering import consecutive_index

CREATED = "created_at"
UPDATED = "last_updated_at"


def _lit_ts(now) -> Column:
    if isinstance(now, Column):
        return now
    return ts_lit(now if now is not None else _dt.datetime.now())


def unique_batch(batch: DataFrame, keys: Sequence[str], ord_col: str | None) -> DataFrame:
    if ord_col is None:
        return batch
    return keep_last(batch, keys, ord_col).drop(ord_col)


def upsert(store: DataFrame, batch: DataFrame, keys: Sequence[str] | str, now=None,
           ord_col: str | None = None, audit: bool = True) -> DataFrame:
    """K04 core. Returns the whole table after the upsert (store columns first,
    then batch-only columns, which are added as new columns)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    batch = unique_batch(batch, keys, ord_col)
    now_c = _lit_ts(now)
    supplied = [c for c in batch.columns if c not in keys and c not in (CREATED, UPDATED)]
    store_cols = list(store.columns)
    out_cols = store_cols + [c for c in batch.columns if c not in store_cols]
    if audit:
        out_cols += [c for c in (CREATED, UPDATED) if c not in out_cols]

    kept = _without(store, batch, keys)
    kept = kept.select(*[F.col(c) if c in store_cols else F.lit(None).alias(c) for c in out_cols])

    b = batch.alias("b")
    s = store.withColumn("_in_store", F.lit(True)).alias("s")
    j = b.join(s, same_keys(keys, "b", "s"), "left")
    stored = F.col("s._in_store").isNotNull()

    def pick(c: str) -> Column:
        if c in keys:
            return F.col(f"b.`{c}`").alias(c)
        if c == CREATED and audit:
            # kept as stored (even NULL) for an existing key, now for a new one
            return (F.when(stored, F.col(f"s.{c}")).otherwise(now_c) if c in store_cols else now_c).alias(c)
        if c == UPDATED and audit:
            return now_c.alias(c)
        if c in supplied:
            return F.col(f"b.{c}").alias(c)
        if c in store_cols:
            return F.col(f"s.{c}").alias(c)
        return F.lit(None).alias(c)

    merged = j.select(*[pick(c) for c in out_cols])
    # Type alignment for columns that only exist on one side.
    merged_types = dict(merged.dtypes)
    kept = kept.select(*[F.col(c).cast(merged_types[c]) for c in out_cols])
    return kept.unionByName(merged)


def _without(store: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored rows whose key is not in the batch."""
    return store.alias("s").join(batch.select(*keys).distinct().alias("b"), same_keys(keys, "s", "b"), "left_anti")


def replace_by_key(store: DataFrame, batch: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Drop stored rows whose key is in the batch, append the batch."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _without(store, batch, keys).unionByName(batch, allowMissingColumns=True)


def delete_by_key(store: DataFrame, doomed: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _without(store, doomed, keys)


def insert_if_absent(store: DataFrame, batch: DataFrame, keys: Sequence[str] | str | None = None) -> DataFrame:
    """Add batch rows whose key (default: the whole row) is not stored."""
    keys = [keys] if isinstance(keys, str) else list(keys or store.columns)
    return store.unionByName(_without(batch.dropDuplicates(keys), store, keys))


# ------------------------------------------------------------ file registry
def upsert_files(files: DataFrame, batch: DataFrame, base_dir: str, now=None) -> DataFrame:
    """K06 + J11: register files by path.

    ``batch``: ``file_path`` (absolute), ``prefix`` (record id), ``file_type``,
    ``file_size`` (bytes), ``description``. A stored row matching the absolute
    path is updated (size, description, upload time); else one matching the
    path relative to ``base_dir`` is updated and its path made absolute; else
    the file is new and gets ``prefix + 'file' + n`` with n the next free number
    of that prefix. Ids are kept on update.
    """
    now_c = _lit_ts(now)
    root = base_dir.rstrip("/") + "/"
    b = (batch.dropDuplicates(["file_path"])
         .withColumn("_rel", F.when(F.col("file_path").startswith(root),
                                    F.substring(F.col("file_path"), len(root) + 1, 1 << 20))))
    st = files.select("file_id", F.col("file_path").alias("_sp"))
    by_abs = b.join(st.withColumnRenamed("file_id", "_id_abs"), b["file_path"] == st["_sp"], "left").drop("_sp")
    st2 = files.select(F.col("file_id").alias("_id_rel"), F.col("file_path").alias("_sp2"))
    res = by_abs.join(st2, by_abs["_rel"] == st2["_sp2"], "left").drop("_sp2")
    res = res.withColumn("_hit", F.coalesce("_id_abs", "_id_rel"))

    size_text = human_size(F.col("file_size"))
    updates = res.where(F.col("_hit").isNotNull()).select(
        F.col("_hit").alias("file_id"), "file_path", size_text.alias("_size"),
        F.col("description").alias("_desc"))

    new = res.where(F.col("_hit").isNull())
    new = consecutive_index(new, ["file_path"], ["prefix"], name="_r")
    # Stored numbers per prefix: ids of the form prefix + 'file' + digits.
    num = F.regexp_extract(F.col("file_id"), r"^(.*)file(\d+)$", 2)
    used = files.select(F.regexp_extract(F.col("file_id"), r"^(.*)file(\d+)$", 1).alias("prefix"),
                        F.when(num != "", num.cast("bigint")).alias("_n")).where(F.col("_n").isNotNull())
    new, _ = allocate(free_intervals(used, "_n", "prefix"), new, "prefix", "_r", name="_num")
    inserts = new.select(
        F.concat(F.col("prefix"), F.lit("file"), F.col("_num").cast("string")).alias("file_id"),
        "file_path", file_stem(F.col("file_path")).alias("file_name"), "file_type",
        size_text.alias("file_size"), now_c.alias("upload_date"), "description")

    touched = updates.select("file_id")
    kept = files.join(touched, "file_id", "left_anti")
    f = files.alias("f")
    upd = (updates.alias("u").join(f, "file_id")
           .select("file_id", F.col("u.file_path").alias("file_path"), F.col("f.file_name"),
                   F.col("f.file_type"), F.col("u._size").alias("file_size"), now_c.alias("upload_date"),
                   F.col("u._desc").alias("description")))
    cols = files.columns
    return kept.select(*cols).unionByName(upd.select(*cols)).unionByName(inserts.select(*cols))


def attach_dataset_ids(configs: DataFrame, catalog: DataFrame, title_col: str = "title",
                       name_col: str = "file_name", id_col: str = "dataset_id") -> DataFrame:
    """Config row -> dataset id where config title == catalog title OR
    config file name == catalog title; untitled catalog rows are skipped; all
    pairs kept. Written as the union of two equi-joins, de-duplicated, so it
    stays a hash join (an OR condition would become a nested-loop join)."""
    cat = catalog.where(F.col(title_col).isNotNull() & (F.col(title_col) != "")) \
        .select(F.col(id_col), F.col(title_col).alias("_ct"))
    parts = [configs.join(cat, configs[c] == cat["_ct"]).drop("_ct")
             for c in (title_col, name_col) if c in configs.columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.dropDuplicates()
