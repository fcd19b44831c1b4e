"""The store of all datasets: rows, their key index and a ledger that makes each change one commit.

```
<root>/rows/c=<commit>/dataset_id=<id>/   seq, row_id, record
<root>/keys-<n>/c=<commit>/               dataset_id, key: bucketed and sorted by both, n buckets
<root>/ledger/<version>-<id>/             pieces, outcomes, sources
<root>/ledger/<version>.done              the commit: names the folder beside it
```

What a change adds is written first, into folders of its own that nothing reads yet; then a new version of the ledger, which lists
the *pieces* the store is made of: a piece is what one commit wrote for one dataset, with its number of rows and its largest sequence. The
``.done`` file comes last and is created only where there is none, so a change is there as a whole or not at all, whichever datasets it
touches, and of two writers that start from one version the second fails and can run again. Appending adds pieces, replacing and deleting leave
pieces out, renaming changes the id beside a piece: no row is rewritten. ``sweep`` deletes what no longer counts.

The ledger has one row for each dataset and commit that still has rows in it (``compact`` merges the pieces of a dataset), so totals (row counts,
largest sequences) come from it and never from the rows. The key index is a bucketed table: an anti-join against it reads keys
alone, and neither shuffles nor sorts them anew. Key texts depend on a dataset's key columns; pieces whose key columns or dataset id changed since they
were indexed are indexed again from their rows, those pieces only.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvest.operators.joins import bounded_broadcast

PIECES = "dataset_id string, c string, stored_as string, kc string, indexed_as string, key_spec string, n bigint, max_seq bigint"
OUTCOMES = "dataset_id string, mode string, status string, downloaded bigint, unique_rows bigint, new_rows bigint, total_rows bigint"
SOURCES = "source string, batch bigint"
ROWS = "seq bigint, row_id string, record string, c string, dataset_id string"


class CommitConflict(RuntimeError):
    """Another commit came first; nothing was changed."""


def payload_map(v: Column) -> Column:
    """Top-level fields of a VARIANT object as map<string,string> (values as text)."""
    return F.try_variant_get(v, "$", "map<string,string>")


def key_text(m: Column, keys: Column) -> Column:
    """JSON text of the key values named by ``keys`` in the field map ``m`` (missing and NULL both -> null)."""
    return F.to_json(F.transform(keys, lambda k: F.element_at(m, k)))


def key_spec(keys: Column) -> Column:
    """The key columns as text; NULL for a dataset without any."""
    return F.when(F.size(keys) > 0, F.to_json(keys))


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        """``buckets`` of the key index count where the store is new: as many as the session's shuffle partitions by default."""
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        found = [n for n in self._names("") if n.startswith("keys-")]
        self.buckets = int(found[0][5:]) if found else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._keys = f"harvest_keys_{hashlib.md5(self.root.encode()).hexdigest()[:16]}"

    # files -------------------------------------------------------------------------------------------------------------
    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.root, *[p for p in parts if p]))

    def _names(self, *parts: str) -> list[str]:
        p = self._path(*parts)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def _at(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    # the ledger --------------------------------------------------------------------------------------------------------
    def version(self) -> int:
        return max((int(n[:-5]) for n in self._names("ledger") if n.endswith(".done")), default=0)

    def _folder(self, version: int) -> str:
        stream = self._fs.open(self._path("ledger", f"{version}.done"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _ledger(self, part: str, schema: str, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], schema)
        folder = self._folder(version)
        if part not in self._names("ledger", folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._at("ledger", folder, part))

    def pieces(self, version: int | None = None) -> DataFrame:
        return self._ledger("pieces", PIECES, version)

    def outcomes(self, version: int | None = None) -> DataFrame:
        """What became of each dataset in the refresh that made this version."""
        return self._ledger("outcomes", OUTCOMES, version)

    def totals(self, version: int | None = None) -> DataFrame:
        """dataset_id, row_count and max_seq of each dataset, from the ledger."""
        return self.pieces(version).groupBy("dataset_id").agg(F.sum("n").alias("row_count"), F.max("max_seq").alias("max_seq"))

    def last_batch(self, source: str) -> int | None:
        """The last batch that a stream committed here."""
        row = self._ledger("sources", SOURCES).where(F.col("source") == source).agg(F.max("batch").alias("b")).first()
        return row["b"]

    def commit(self, pieces: DataFrame, based_on: int, outcomes: DataFrame | None = None, source: tuple[str, int] | None = None) -> int:
        """Make ``pieces`` the store's. The step that counts is the last."""
        folder = f"{based_on + 1}-{uuid.uuid4().hex}"
        pieces.select(*[c.split()[0] for c in PIECES.split(", ")]).write.parquet(self._at("ledger", folder, "pieces"))
        if outcomes is not None:
            outcomes.select(*[c.split()[0] for c in OUTCOMES.split(", ")]).write.parquet(self._at("ledger", folder, "outcomes"))
        if source or based_on and "sources" in self._names("ledger", self._folder(based_on)):
            sources = self._ledger("sources", SOURCES, based_on)
            if source:
                sources = sources.where(F.col("source") != source[0]).unionByName(self.spark.createDataFrame([source], SOURCES))
            sources.write.parquet(self._at("ledger", folder, "sources"))
        try:
            out = self._fs.create(self._path("ledger", f"{based_on + 1}.done"), False)
        except Exception as e:
            if self._fs.exists(self._path("ledger", f"{based_on + 1}.done")):
                raise CommitConflict(f"version {based_on + 1} is there already") from e
            raise
        out.write(folder.encode())
        out.close()
        return based_on + 1

    # rows --------------------------------------------------------------------------------------------------------------
    def rows(self, only: DataFrame | None = None, pieces: DataFrame | None = None) -> DataFrame:
        """dataset_id, seq, row_id, record: of all datasets, or of those in the one-column frame ``only``. The folders of
        pieces that are not read are not opened (they are partitions, joined to the ledger)."""
        pieces = self.pieces() if pieces is None else pieces
        if only is not None:
            pieces = pieces.join(only.select(F.col(only.columns[0]).alias("dataset_id")).distinct(), "dataset_id", "left_semi")
        live = pieces.select(F.col("c").alias("_c"), F.col("stored_as").alias("_s"), F.col("dataset_id").alias("_id"))
        commits = [r[0] for r in live.select("_c").distinct().collect()]          # one for each refresh with rows still in use
        if not commits:
            return self.spark.createDataFrame([], "dataset_id string, seq bigint, row_id string, record string")
        read = self.spark.read.schema(ROWS).option("basePath", self._at("rows")).parquet(*[self._at("rows", f"c={c}") for c in commits])
        return (read.join(bounded_broadcast(live), (F.col("c") == F.col("_c")) & (F.col("dataset_id") == F.col("_s")))
                .select(F.col("_id").alias("dataset_id"), "seq", "row_id", "record"))

    def stage_rows(self, rows: DataFrame) -> str:
        """Write dataset_id, seq, row_id, record into a commit's folder, files by dataset; large datasets are split among tasks."""
        c = uuid.uuid4().hex
        rows.select("seq", "row_id", "record", "dataset_id").hint("rebalance", "dataset_id").write.partitionBy("dataset_id").parquet(self._at("rows", f"c={c}"))
        return c

    # the key index -----------------------------------------------------------------------------------------------------
    def _key_table(self) -> str:
        if not self.spark.catalog.tableExists(self._keys):
            self._fs.mkdirs(self._path(f"keys-{self.buckets}"))
            self.spark.sql(f"CREATE TABLE {self._keys} (dataset_id STRING, key STRING, c STRING) USING parquet PARTITIONED BY (c) "
                           f"CLUSTERED BY (dataset_id, key) SORTED BY (dataset_id, key) INTO {self.buckets} BUCKETS LOCATION '{self._at(f'keys-{self.buckets}')}'")
        self.spark.catalog.recoverPartitions(self._keys)        # commits of other sessions too
        return self._keys

    def stage_keys(self, keys: DataFrame, c: str) -> None:
        """Index the distinct (dataset_id, key) of a commit: one file a bucket."""
        table = self._key_table()
        each = keys.select("dataset_id", "key").repartition(self.buckets, "dataset_id", "key").distinct()
        each.select("dataset_id", "key", F.lit(c).alias("c")).write.insertInto(table)

    def known_keys(self, version: int | None = None) -> DataFrame:
        """dataset_id and key of all stored rows whose index is up to date, read from the index alone."""
        live = self.pieces(version).where("indexed_as = dataset_id").select(F.col("kc").alias("_kc"), F.col("dataset_id").alias("_id"))
        index = self.spark.table(self._key_table())
        return (index.join(bounded_broadcast(live), (index["c"] == F.col("_kc")) & (index["dataset_id"] == F.col("_id")), "left_semi")
                .select("dataset_id", "key"))

    def reindex(self, configs: DataFrame) -> bool:
        """Index the pieces anew whose dataset has other key columns, or another id, than when they were indexed. ``configs``: dataset_id, keys."""
        version = self.version()
        pieces = self.pieces(version)
        specs = configs.select(F.col("dataset_id").alias("_id"), key_spec(F.col("keys")).alias("_spec"), F.col("keys").alias("_keys"))
        marked = pieces.join(bounded_broadcast(specs), pieces["dataset_id"] == F.col("_id"), "left")
        odd = F.col("_spec").isNotNull() & ~(F.col("indexed_as").eqNullSafe(F.col("dataset_id")) & F.col("key_spec").eqNullSafe(F.col("_spec")))
        if not marked.where(odd).limit(1).count():
            return False
        rows = self.rows(pieces=marked.where(odd).select(pieces["*"])).join(bounded_broadcast(specs), F.col("dataset_id") == F.col("_id"))
        c = uuid.uuid4().hex
        self.stage_keys(rows.select("dataset_id", key_text(payload_map(F.try_parse_json("record")), F.col("_keys")).alias("key")), c)
        fresh = {"kc": F.lit(c), "indexed_as": F.col("dataset_id"), "key_spec": F.col("_spec")}
        self.commit(marked.select(*[F.when(odd, fresh[n]).otherwise(F.col(n)).alias(n) if n in fresh else F.col(n) for n in pieces.columns]), version)
        return True

    # changes without rows ----------------------------------------------------------------------------------------------
    def rename(self, old: str, new: str) -> bool:
        """Give a dataset another id; refused where the new id has rows or the old one has none. Rows keep their row ids."""
        version = self.version()
        pieces = self.pieces(version)
        have = {r[0] for r in pieces.where(F.col("dataset_id").isin(old, new)).select("dataset_id").distinct().collect()}
        if have != {old} or old == new:
            return False
        self.commit(pieces.withColumn("dataset_id", F.when(F.col("dataset_id") == old, F.lit(new)).otherwise(F.col("dataset_id"))), version)
        return True

    def delete(self, ids: DataFrame) -> int:
        """Leave out the datasets of a one-column frame; the number of those that had rows."""
        version = self.version()
        pieces, doomed = self.pieces(version), ids.select(F.col(ids.columns[0]).alias("dataset_id")).distinct()
        found = pieces.join(doomed, "dataset_id", "left_semi").select("dataset_id").distinct().count()
        if found:
            self.commit(pieces.join(doomed, "dataset_id", "left_anti"), version)
        return found

    def compact(self, over: int = 32) -> bool:
        """Merge the pieces of each dataset that has more than ``over`` of them, and their indexes."""
        version = self.version()
        pieces = self.pieces(version)
        many = pieces.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > over).select("dataset_id")
        old = pieces.join(many, "dataset_id", "left_semi")
        if not old.limit(1).count():
            return False
        c = self.stage_rows(self.rows(pieces=old))
        sound = F.max("key_spec").eqNullSafe(F.min("key_spec")) & (F.count("key_spec") == F.count(F.lit(1))) & F.min(F.col("indexed_as").eqNullSafe(F.col("dataset_id")))
        merged = old.groupBy("dataset_id").agg(F.when(sound, F.max("key_spec")).alias("key_spec"), F.sum("n").alias("n"), F.max("max_seq").alias("max_seq"))
        self.stage_keys(self.known_keys(version).join(merged.where("key_spec IS NOT NULL").select("dataset_id"), "dataset_id", "left_semi"), c)
        indexed = F.col("key_spec").isNotNull()
        merged = merged.select("dataset_id", F.lit(c).alias("c"), F.col("dataset_id").alias("stored_as"), F.when(indexed, F.lit(c)).alias("kc"),
                               F.when(indexed, F.col("dataset_id")).alias("indexed_as"), "key_spec", "n", "max_seq")
        self.commit(pieces.join(many, "dataset_id", "left_anti").unionByName(merged), version)
        return True

    def sweep(self) -> int:
        """Delete folders that the current version does not name, and earlier versions. Not while another job writes or reads the store."""
        version = self.version()
        rows = {r[0] for r in self.pieces(version).select("c").distinct().collect()}
        keys = {r[0] for r in self.pieces(version).where("kc IS NOT NULL").select("kc").distinct().collect()}
        index, folder = f"keys-{self.buckets}", self._folder(version) if version else None
        doomed = [("rows", n) for n in self._names("rows") if n.startswith("c=") and n[2:] not in rows]
        doomed += [(index, n) for n in self._names(index) if n.startswith("c=") and n[2:] not in keys]
        doomed += [("ledger", n) for n in self._names("ledger") if n not in (folder, f"{version}.done")]
        for place, name in doomed:
            if place == index and self.spark.catalog.tableExists(self._keys):
                self.spark.sql(f"ALTER TABLE {self._keys} DROP IF EXISTS PARTITION (c='{name[2:]}')")
            self._fs.delete(self._path(place, name), True)
        return len(doomed)

    def close(self) -> None:
        """Forget the index's table entry in this session; the files stay."""
        try:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._keys}")
        except AnalysisException:
            pass

    def remove(self) -> None:
        """Delete the whole store."""
        self.close()
        self._fs.delete(self._path(""), True)
