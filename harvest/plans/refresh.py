"""Whole-catalog jobs: refresh every dataset in one plan (lifecycle 3.1), write
the refresh into the store as one commit, and
de-duplicate / merge every dataset in one aggregate each (lifecycle 3.2).

All datasets share one row table ``(dataset_id, _ord, v VARIANT)``; per-dataset
settings come from a config table (one row per dataset, broadcast-sized by
construction: it has as many rows as the catalog):

* ``keys array<string>`` -- the identity key (the sort-key columns);
* ``sort_keys array<array<string>>`` -- the typed sort spec ``[field, type]``;
  rows are numbered in this order (then landing order), as the original sorts
  each batch before assigning ids;
* ``date_col string`` -- date column for the cutoff filter (NULL: no filter);
* ``title string`` -- routes code-list / spatial datasets to full replace;
* ``merge_keys array<string>``, ``auto_merge boolean`` -- keep-last merge.

A row's key is the JSON text of its key values, looked up by name in the
payload, so one equi-join / one aggregate on ``(dataset_id, key)`` serves
every dataset at once -- no loop over tables.

A refresh reads each landed payload once for a narrow frame (key, sort key,
date, content hash), which is reduced to distinct rows and cut; load mode, anti-join and
numbering work on that, and only rows that are stored in the end fetch their
payload again, by ordinal.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from harvest.functions.times import ts_lit
from harvest.functions.dates import parse_date
from harvest.functions.text import CODE_LIST_WORD, MAP_URL_FIELD, compose_id
from harvest.operators.dedup import keep_first, keep_last
from harvest.operators.ids import assign_ids, max_sequence
from harvest.operators.joins import bounded_broadcast
from harvest.operators.ordering import spec_sort_key
from harvest.operators.quality import load_mode
from harvest.session import checkpoint_dir
from harvest.store import Store, key_spec, key_text, payload_map


def _with_config(rows: DataFrame, configs: DataFrame, cols) -> DataFrame:
    # One config row per dataset (the catalog's size); broadcast after a row-count check.
    return rows.join(bounded_broadcast(configs.select("dataset_id", *cols)), "dataset_id", "left")


def _cut(small: DataFrame) -> DataFrame:
    checkpoint_dir(small.sparkSession)
    return small.checkpoint()


def narrow_rows(rows: DataFrame, configs: DataFrame, cutoff: _dt.datetime | None) -> DataFrame:
    """What a refresh needs of the landed rows but their payload: dataset_id, _ord, _hash (of the content), title, _spec (the
    dataset's key columns as text, NULL without any), _key, _sk (sort key), _map_url and _in (on or after the cutoff)."""
    spec_cols = ["sort_keys"] if "sort_keys" in configs.columns else []
    r = _with_config(rows, configs, ["keys", "date_col", "title", *spec_cols]).withColumn("_m", payload_map(F.col("v")))
    sort_key = spec_sort_key(F.col("_m"), F.col("sort_keys")) if spec_cols else F.array()
    inside = F.lit(True) if cutoff is None else F.col("date_col").isNull() | F.coalesce(parse_date(F.element_at("_m", F.col("date_col"))) >= ts_lit(cutoff), F.lit(False))
    return r.select("dataset_id", "_ord", F.sha2(F.to_json("v"), 256).alias("_hash"), "title", key_spec(F.col("keys")).alias("_spec"),
                    key_text(F.col("_m"), F.col("keys")).alias("_key"), sort_key.alias("_sk"),
                    F.element_at("_m", F.lit(MAP_URL_FIELD)).alias("_map_url"), inside.alias("_in"))


def plan_refresh(rows: DataFrame, configs: DataFrame, known: DataFrame, totals: DataFrame, cutoff: _dt.datetime | None = None,
                 replace: bool = True) -> tuple[DataFrame, DataFrame]:
    """Which landed rows go into the store, and what becomes of each dataset.

    ``rows``: landed ``(dataset_id, _ord, v)``, no ordinal twice in a dataset; ``known``: stored (dataset_id, key); ``totals``: stored
    (dataset_id, row_count, max_seq). Exact copies of a row go first (A03). Per dataset: date cutoff on its date column, load mode
    from its title and its first row after cut and sort, then either every row with ids from 1 (full replace) or only rows whose key is not
    stored, with ids after the stored maximum. A dataset without key columns can be replaced, but not compared: unless its mode
    is ``full``, nothing of it is stored and its status is ``error``; so it is for rows without a dataset id. Without ``replace``, no dataset is in full mode.

    Returns (dataset_id, _ord, _key, _spec, mode, seq, row_id) of the rows to store, and (dataset_id, mode, status, downloaded, unique_rows,
    stored_rows) of each landed dataset; status ``error``, ``ok`` otherwise."""
    checkpoint_dir(rows.sparkSession)
    n = narrow_rows(rows, configs, cutoff)
    rest = [c for c in n.columns if c not in ("dataset_id", "_hash")]
    first_copies = (n.groupBy("dataset_id", "_hash").agg(F.min_by(F.struct(*rest), "_ord").alias("_r"), F.count(F.lit(1)).alias("_n"))
                    .select("dataset_id", "_r.*", "_n").checkpoint())
    kept = first_copies.where("_in")
    # One row per dataset, made once; broadcast behind a size check, so that landed rows are not shuffled by dataset.
    head = kept.groupBy("dataset_id").agg(F.min_by(F.col("_map_url"), F.struct("_sk", "_ord")).alias("_url"))
    sizes = first_copies.groupBy("dataset_id").agg(F.sum("_n").alias("downloaded"), F.count(F.lit(1)).alias("unique_rows"),
                                                   F.any_value("title").alias("title"), F.any_value("_spec").alias("_spec"))
    mode = load_mode(F.col("title"), F.col("_url")) if replace else F.lit("incremental")
    nameless = F.coalesce("dataset_id", F.lit("")) == ""
    status = F.when(nameless | (mode != "full") & F.col("_spec").isNull(), "error").otherwise("ok")
    datasets = (sizes.join(head, "dataset_id", "left").join(totals.select("dataset_id", F.col("row_count").alias("stored_rows"), "max_seq"), "dataset_id", "left")
                .select("dataset_id", mode.alias("mode"), status.alias("status"), "downloaded", "unique_rows", F.coalesce("stored_rows", F.lit(0)).alias("stored_rows"),
                        "max_seq").checkpoint())
    kept = kept.join(bounded_broadcast(datasets.where("status = 'ok'").select("dataset_id", "mode")), "dataset_id")
    cols = ["dataset_id", "_ord", "_key", "_spec", "mode", "_sk"]
    inc = kept.where("mode = 'incremental'")
    known = _of_datasets(known, datasets.where("status = 'ok' AND mode = 'incremental'").select("dataset_id"))
    new = inc.join(known, (inc["dataset_id"] == known["dataset_id"]) & (inc["_key"] == known["key"]), "left_anti")
    # One numbering for both modes: datasets in full mode start after 0.
    start = datasets.where("mode = 'incremental' AND max_seq IS NOT NULL").select("dataset_id", "max_seq")
    out = assign_ids(kept.where("mode = 'full'").select(*cols).unionByName(new.select(*cols)), ["_sk", "_ord"], "dataset_id", start=start)
    return out.drop("_sk"), datasets.drop("max_seq")


#: Datasets that are named in a filter on the key index, whose files are sorted by dataset; beyond, they are joined.
PRUNE_MAX_DATASETS = 1000


def _of_datasets(known: DataFrame, ids: DataFrame) -> DataFrame:
    few = [r["dataset_id"] for r in ids.limit(PRUNE_MAX_DATASETS + 1).collect()]
    if len(few) <= PRUNE_MAX_DATASETS:
        return known.where(F.col("dataset_id").isin(few))
    return known.join(ids, "dataset_id", "left_semi")


def with_records(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` (dataset_id, _ord, ...) with the payload of each row as JSON text."""
    return chosen.join(rows.select("dataset_id", "_ord", "v"), ["dataset_id", "_ord"]).withColumn("record", F.to_json("v")).drop("v")


def refresh_all(rows: DataFrame, store: Store | DataFrame, configs: DataFrame, cutoff: _dt.datetime | None = None) -> DataFrame:
    """Lifecycle 3.1 for every dataset together, without writing: the rows that ``refresh_store`` would store.

    ``store``: a Store, of which only the key index and the ledger are read, or a frame of stored rows ``(dataset_id, seq, record)``, the record
    as JSON text or as a VARIANT ``v``. Returns ``dataset_id, _ord, mode, seq, row_id, record``."""
    configs = _cut(configs)
    if isinstance(store, Store):
        store.reindex(configs)
        known, totals = store.known_keys(), store.totals()
    else:
        if "v" not in store.columns:
            store = store.select("dataset_id", "seq", F.try_parse_json("record").alias("v"))
        s = _with_config(store, configs, ["keys"])
        known = s.select("dataset_id", key_text(payload_map(F.col("v")), F.col("keys")).alias("key")).distinct()
        totals = max_sequence(store, "seq", ["dataset_id"]).join(store.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("row_count")), "dataset_id")
    new, _ = plan_refresh(rows, configs, known, totals, cutoff)
    return with_records(rows, new).select("dataset_id", "_ord", "mode", "seq", "row_id", "record")


def refresh_store(rows: DataFrame, store: Store, configs: DataFrame, cutoff: _dt.datetime | None = None, source: tuple[str, int] | None = None,
                  replace: bool = True) -> DataFrame:
    """Lifecycle 3.1 with its writes, as one commit: the rows of datasets in ``full`` mode replace what is stored of them, the new rows
    of the others are added (K01, K02), with their keys. A run that broke off left nothing that counts and can be run again.
    ``source`` (name, batch number) is noted with the commit; a batch that the store has from that source is left out.

    Returns the outcome of each landed dataset, as stored with the commit (A07, A08): dataset_id, mode, status (``updated``, ``unchanged``,
    ``error``), downloaded, unique_rows, new_rows, total_rows."""
    last = store.last_batch(source[0]) if source else None
    if last is not None and last >= source[1]:
        return store.outcomes()
    configs = _cut(configs)
    store.reindex(configs)
    version = store.version()
    new, datasets = plan_refresh(rows, configs, store.known_keys(version), store.totals(version), cutoff, replace)
    added = new.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("max_seq"), F.any_value("_spec").alias("key_spec")).checkpoint()
    expected = added.agg(F.sum("n")).first()[0] or 0
    pieces = store.pieces(version)
    if expected:
        written = Observation("rows written")
        c = store.stage_rows(with_records(rows, new).observe(written, F.count(F.lit(1)).alias("n")))
        if written.get["n"] != expected:
            raise ValueError(f"{written.get['n']} payloads for {expected} new rows: an ordinal occurs twice in a dataset")
        store.stage_keys(new.where("_spec IS NOT NULL").select("dataset_id", F.col("_key").alias("key")), c)
        indexed = F.col("key_spec").isNotNull()
        fresh = added.select("dataset_id", F.lit(c).alias("c"), F.col("dataset_id").alias("stored_as"), F.when(indexed, F.lit(c)).alias("kc"),
                             F.when(indexed, F.col("dataset_id")).alias("indexed_as"), "key_spec", "n", "max_seq")
        replaced = bounded_broadcast(datasets.where("mode = 'full'").join(added, "dataset_id", "left_semi").select("dataset_id"))
        pieces = pieces.join(replaced, "dataset_id", "left_anti").unionByName(fresh)
    news = F.coalesce("n", F.lit(0))
    outcomes = datasets.join(added.select("dataset_id", "n"), "dataset_id", "left").select(
        "dataset_id", "mode", F.when(F.col("status") == "error", "error").when(news > 0, "updated").otherwise("unchanged").alias("status"), "downloaded", "unique_rows",
        news.alias("new_rows"), F.when((F.col("mode") == "full") & (news > 0), news).otherwise(F.col("stored_rows") + news).alias("total_rows"))
    return store.outcomes(store.commit(pieces, version, outcomes, source))


def load_store(store: Store, rows: DataFrame, configs: DataFrame) -> None:
    """Put rows with known sequences, (dataset_id, seq, v), into the store as they are: the first load of an existing table."""
    version = store.version()
    r = _cut(_with_config(rows, configs, ["keys"]).select("dataset_id", "seq", key_spec(F.col("keys")).alias("key_spec"), key_text(payload_map(F.col("v")), F.col("keys")).alias("key")))
    c = store.stage_rows(rows.select("dataset_id", "seq", dataset_row_id("dataset_id", "seq").alias("row_id"), F.to_json("v").alias("record")))
    store.stage_keys(r.where("key_spec IS NOT NULL"), c)
    indexed = F.col("key_spec").isNotNull()
    fresh = (r.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("max_seq"), F.any_value("key_spec").alias("key_spec"))
             .select("dataset_id", F.lit(c).alias("c"), F.col("dataset_id").alias("stored_as"), F.when(indexed, F.lit(c)).alias("kc"),
                     F.when(indexed, F.col("dataset_id")).alias("indexed_as"), "key_spec", "n", "max_seq"))
    store.commit(store.pieces(version).unionByName(fresh), version)


def dedup_all(rows: DataFrame, configs: DataFrame, order_col: str = "row_id") -> DataFrame:
    """Lifecycle 3.2 for every dataset together: keep the first row (by
    ``order_col``) per (dataset, sort key); then, for datasets whose merge is
    switched on (``auto_merge`` true) and whose title is not a code list, keep
    the last row per (dataset, merge key). Datasets without keys are untouched."""
    r = _with_config(rows, configs, ["keys", "merge_keys", "auto_merge", "title"])
    has_keys = F.col("keys").isNotNull() & (F.size("keys") > 0)
    keyed = (r.where(has_keys).withColumn("_m", payload_map(F.col("v")))
             .withColumn("_key", key_text(F.col("_m"), F.col("keys"))).drop("_m"))
    untouched = r.where(~has_keys | F.col("keys").isNull())
    cols = list(rows.columns)
    step1 = keep_first(keyed.select(*cols, "merge_keys", "auto_merge", "title", "_key"),
                       ["dataset_id", "_key"], order_col).drop("_key")
    step1 = step1.unionByName(untouched.select(*cols, "merge_keys", "auto_merge", "title"))
    merge_on = (F.coalesce(F.col("auto_merge"), F.lit(False)) & F.col("merge_keys").isNotNull()
                & (F.size("merge_keys") > 0) & ~F.contains(F.coalesce(F.col("title"), F.lit("")), F.lit(CODE_LIST_WORD)))
    to_merge = (step1.where(merge_on).withColumn("_m", payload_map(F.col("v")))
                .withColumn("_mkey", key_text(F.col("_m"), F.col("merge_keys"))).drop("_m"))
    kept = step1.where(~merge_on)
    merged = keep_last(to_merge.select(*cols, "_mkey"), ["dataset_id", "_mkey"], order_col).drop("_mkey")
    return kept.select(*cols).unionByName(merged.select(*cols))


def dataset_row_id(dataset_col: str, seq_col: str) -> Column:
    return compose_id(F.col(dataset_col), F.col(seq_col), 7)
