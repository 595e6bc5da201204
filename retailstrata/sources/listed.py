"""Tables of plain files with a list of those that count: changed and late rows are merged by key.

A table is a folder with the files of every load (``data/load=...``) and a list for every version. A merge finds the files
that hold a changed key, writes their other rows together with the changes to new files, and then writes the next
list: the one step that makes the change visible. What changes is found by keys and hashes of the other columns, and marked by the
place of a row in its file: whole rows are shuffled once, when they are written. All other files keep their name and bytes. A merge that fails before
that leaves files that no list names. A reader takes the last list and keeps what it names, whatever is merged
meanwhile. One writer at a time.

The list can hold the smallest and largest value of some columns in every file. A read that asks for a range of one of them opens
only the files that may have it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rows import dedup, quoted
from .layout import clustered
from .packed import can_pack, gathered_packed
from .scratch import GIVEN, few_rows, release, remove, shared_folder, smaller_tasks
from .tables import COMPRESSION, gathered

_FILE = "__file"
# The place of a row is the number of its file and its row in that file in one number; so many rows share a row of marks.
_ROW_BITS, _BLOCK_BITS = 40, 15
# A task is given so much of packed rows, which take up several times that in memory.
PACKED = 24 << 20
# Changes that are fewer than one of so many stored rows are worth a search for the files that hold their keys.
_FEW = 10
# Types whose hash tells values apart (a null leaves the hash of an array or structure as it is).
_HASHED = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def scanned_again(df: DataFrame) -> bool:
    """Whether ``df`` is read from Parquet files row by row, and gives the same rows whenever it is read.

    A time of day is asked for anew by each run, so rows with one are not.
    """
    query = df._jdf.queryExecution()
    if query.analyzed().containsPattern(df.sparkSession._jvm.org.apache.spark.sql.catalyst.trees.TreePattern.CURRENT_LIKE()):
        return False
    plan = query.optimizedPlan()
    while plan.nodeName() in ("Project", "Filter") and plan.deterministic():
        plan = plan.children().apply(0)
    if plan.getClass().getSimpleName() != "LogicalRelation" or plan.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return False
    return plan.relation().fileFormat().toString() == "Parquet"


@dataclass(frozen=True)
class ListedTable:
    """``key`` names one row (a null key is a key like any other); files are written by ``partition_by``, or, with
    ``cluster_by``, as ``files_each`` ranges of a load close in those columns, whose smallest and largest values are listed."""

    spark: SparkSession
    path: str
    key: str
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    files_each: int = 64

    # --- the lists -----------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        """Those that can be read, the current one last."""
        lists = self.spark.read.schema("file string, version int").parquet(f"{self.path}/lists")
        return sorted(r["version"] for r in lists.select("version").distinct().collect())

    def _entries(self, version: int | None = None) -> DataFrame:
        """``file`` and, for each column that is clustered by, ``lo_`` and ``hi_`` its values, of a version."""
        chosen = self.versions()[-1] if version is None else version
        return self.spark.read.parquet(f"{self.path}/lists/version={chosen}").where("file is not null")

    def files(self, version: int | None = None) -> list[str]:
        """The files of a version, the current one by default."""
        return sorted(r["file"] for r in self._entries(version).select("file").collect())

    def _put_list(self, version: int, entries: DataFrame) -> None:
        # A row without a file makes the list of an empty table a list.
        none = few_rows(self.spark, ["file"], [(None,)], "file string")
        entries.unionByName(none, allowMissingColumns=True).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/lists/version={version}")

    def _listed(self, files: Sequence[str]) -> DataFrame:
        """The entries of newly written files."""
        names = few_rows(self.spark, ["file"], [(f,) for f in files], "file string")
        if not self.cluster_by:
            return names
        ends = [f(quoted(c)).alias(f"{name}_{c}") for c in self.cluster_by for name, f in (("lo", F.min), ("hi", F.max))]
        found = self._scan(files).groupBy(F.col(_FILE).alias("file")).agg(*ends)
        return names.join(found, "file", "left")

    # --- reading ---------------------------------------------------------------------------------------

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.spark.read.parquet(f"{self.path}/schema").first()["schema"]))

    def _scan(self, files: Sequence[str]) -> DataFrame:
        """The rows of some files with the file of each."""
        schema = self.schema()
        if not files:
            return self.spark.createDataFrame([], schema).withColumn(_FILE, F.lit(None).cast("string"))
        scan = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*map(unquote, files))
        return scan.select(*map(quoted, schema.names), F.col("_metadata.file_path").alias(_FILE))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the current one by default."""
        return self._scan(self.files(version)).drop(_FILE)

    def read_between(self, column: str, low: object, high: object, version: int | None = None) -> DataFrame:
        """Rows with a value of a column that is clustered by from ``low`` to ``high``; other files are not opened."""
        if column not in self.cluster_by:
            raise ValueError(f"the table is not clustered by {column}")
        there = (F.col(quoted(f"lo_{column}")) <= F.lit(high)) & (F.col(quoted(f"hi_{column}")) >= F.lit(low))
        files = [r["file"] for r in self._entries(version).where(there).select("file").collect()]
        return self._scan(files).drop(_FILE).where(F.col(quoted(column)).between(F.lit(low), F.lit(high)))

    # --- writing ---------------------------------------------------------------------------------------

    def _load(self, rows: DataFrame) -> list[str]:
        """Write rows to files of their own; their names."""
        folder, given = f"{self.path}/data/load=l{uuid4().hex}", GIVEN
        by = () if self.cluster_by else self.partition_by
        if self.cluster_by:
            rows = clustered(rows, self.cluster_by, self.files_each)
        elif not by:
            rows = rows.hint("rebalance")
        elif can_pack(rows):
            rows, given = gathered_packed(rows, by).sortWithinPartitions(*map(quoted, [*by, self.key])), PACKED
        else:
            rows = gathered(rows, by, [self.key])
        with smaller_tasks(self.spark, given=given):
            rows.write.parquet(folder, partitionBy=[*by], compression=COMPRESSION["parquet"])
        release(self.spark)
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        found = listing.load(folder).select(F.col("_metadata.file_path").alias("file")).collect()
        return [r["file"] for r in found]

    def create(self, df: DataFrame, version: str | None = None) -> int:
        """The first version, one row of each key as ``merge`` chooses them."""
        text = json.dumps(df.schema.jsonValue())
        # A creation that failed is begun again.
        few_rows(self.spark, ["schema"], [(text,)], "schema string").write.mode("overwrite").parquet(f"{self.path}/schema")
        work = f"{shared_folder(self.spark)}/create-{uuid4().hex}"
        try:
            self._put_list(0, self._listed(self._load(self._one_each(df, version, work))))
        finally:
            remove(self.spark, work)
        return 0

    def _one_each(self, df: DataFrame, version: str | None, work: str) -> DataFrame:
        """One row of each key, in files. Only keys are shuffled, and whole rows where one repeats."""
        rows = self._given(df, work)
        most = rows.groupBy(quoted(self.key)).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0]
        return rows if (most or 0) < 2 else self._stored(self._newest(rows, version), f"{work}/staged")

    def _given(self, df: DataFrame, work: str) -> DataFrame:
        """The rows in files, which a scan gives again as often as they are asked for: stored only if they are not."""
        return df if scanned_again(df) else self._stored(df, f"{work}/given")

    def _newest(self, df: DataFrame, version: str | None) -> DataFrame:
        """One row of each key: the newest, of equally new ones the largest by all columns; without versions as ``dedup``."""
        if version is None:
            return dedup(df, [self.key])
        others = [version, *(c for c in df.columns if c not in (self.key, version))]
        kept = df.groupBy(quoted(self.key)).agg(F.max(F.struct(*map(quoted, others))).alias("__kept"))
        fields = {c: F.col("__kept").getField(c).alias(c) for c in others}
        return kept.select(*[fields.get(c, F.col(quoted(c))) for c in df.columns])

    def merge(self, changes: DataFrame, version: str | None = None) -> int:
        """Put changed rows in the place of those with their key, and new ones beside them; the version then current.

        With ``version``, the name of a column, a late row that is older than the stored one is left out; of equally
        new ones the change counts. Changes that say what is stored already are none: merging the same again
        writes nothing.
        """
        number = self.versions()[-1]
        files = self.files(number)
        columns = self.schema().names
        if sorted(changes.columns) != sorted(columns):
            raise ValueError(f"columns {sorted(changes.columns)} are not those of the table, {sorted(columns)}")
        work = f"{shared_folder(self.spark)}/merge-{uuid4().hex}"
        try:
            staged = self._given(changes.select(*map(quoted, columns)), work)
            met = self._files_with(files, staged) if staged.count() * _FEW < self._scan(files).count() else files
            own, marks = self._marks(met, staged, version, f"{work}/marks")
            if not marks.where("again").isEmpty():
                staged = self._stored(self._newest(staged, version), f"{work}/staged")
                own, marks = self._marks(met, staged, version, f"{work}/marks-of-staged")
            marked = {r["file"] for r in marks.select(F.shiftright("__block", _ROW_BITS - _BLOCK_BITS).alias("file")).distinct().collect()}
            if not marked:
                return number
            touched = {f: n for n, f in enumerate(met) if n in marked}
            rows = self._marked(self._placed(staged, own), marks, True)
            if touched:
                rest = self._marked(self._placed(self._scan([*touched]).drop(_FILE), touched), marks, False)
                rows = rest.unionByName(rows)
            added = self._load(self._stored(rows, f"{work}/rows") if self.cluster_by else rows)
            gone = few_rows(self.spark, ["file"], [(f,) for f in touched], "file string")
            entries = self._entries(number).join(gone, "file", "left_anti")
            self._put_list(number + 1, entries.unionByName(self._listed(added), allowMissingColumns=True))
            return number + 1
        finally:
            remove(self.spark, work)

    def _stored(self, df: DataFrame, path: str) -> DataFrame:
        with smaller_tasks(self.spark):
            df.write.parquet(path, compression=COMPRESSION["parquet"])
        return self.spark.read.schema(df.schema).parquet(path)

    def _same_key(self, a: str, b: str) -> Column:
        return F.col(f"{a}.{quoted(self.key)}").eqNullSafe(F.col(f"{b}.{quoted(self.key)}"))

    def _files_with(self, files: list[str], staged: DataFrame) -> list[str]:
        """The files with a staged key. Of the stored rows only keys are read, and a hash goes along for the file."""
        number = F.xxhash64(_FILE).alias("file")
        keys = self._scan(files).select(quoted(self.key), number).alias("t")
        there = keys.join(staged.select(quoted(self.key)).alias("s"), self._same_key("t", "s"), "left_semi").select("file").distinct()
        names = few_rows(self.spark, [_FILE], [(f,) for f in files], f"{_FILE} string").select(_FILE, number)
        return [r[_FILE] for r in names.join(there, "file").select(_FILE).collect()]

    def _placed(self, rows: DataFrame, numbers: dict[str, int]) -> DataFrame:
        """Rows of numbered files with the place of each."""
        starts = few_rows(self.spark, [_FILE, "__start"], [(f, n << _ROW_BITS) for f, n in numbers.items()], f"{_FILE} string, __start bigint")
        found = rows.select(*map(quoted, rows.columns), F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias("__row"))
        place = (F.col("__start") + F.col("__row")).alias("__place")
        return found.join(F.broadcast(starts), _FILE).select(*map(quoted, rows.columns), place)

    def _marks(self, files: Sequence[str], staged: DataFrame, version: str | None, path: str) -> tuple[dict[str, int], DataFrame]:
        """Marks at the places of staged rows that change something and of stored rows they replace, or, ``again``, of a key that
        is staged more than once; before them the numbers of the staged rows' files, which follow those of ``files``.

        Keys are shuffled with the version and a hash of 64 bits of the columns, by which rows of one key and version are told apart.
        """
        names = staged.select(F.col("_metadata.file_path").alias("file")).distinct().collect()
        own = {r["file"]: n for n, r in enumerate(names, len(files))}
        fields = self.schema().fields
        hashed = [c for f in fields if isinstance(f.dataType, _HASHED) for c in (F.col(quoted(f.name)), F.col(quoted(f.name)).isNull())]
        whole = [F.col(quoted(f.name)).alias(f"__c{i}") for i, f in enumerate(fields) if not isinstance(f.dataType, _HASHED)]
        at = [F.col(quoted(version)).alias("__at")] if version is not None else []
        values = [F.xxhash64(*hashed).alias("__hash"), *whole, *at]

        rows = self._placed(staged, own)
        if files:
            rows = self._placed(self._scan(files).drop(_FILE), {f: n for n, f in enumerate(files)}).unionByName(rows)
        rows = rows.select(F.col(quoted(self.key)).alias("__key"), "__place", *values)
        is_staged, value = F.col("__place") >= F.lit(len(files) << _ROW_BITS), F.struct(*rows.columns[2:])
        key = Window.partitionBy("__key")
        rows = rows.select(
            "__place",
            F.first(F.when(is_staged, value), True).over(key).alias("s"),
            F.first(F.when(~is_staged, value), True).over(key).alias("t"),
            F.sum(is_staged.cast("int")).over(key).alias("__n"),
        )
        nothing = F.col("s").eqNullSafe(F.col("t"))
        if version is not None:
            nothing = nothing | F.coalesce(F.col("t.__at") > F.col("s.__at"), F.lit(False))
        changed = F.col("s").isNotNull() & ((F.col("__n") > 1) | F.col("t").isNull() | ~nothing)
        bit = F.col("__place").bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1))
        found = rows.where(changed).select(F.shiftright("__place", _BLOCK_BITS).alias("__block"), bit.alias("bit"), (F.col("__n") > 1).alias("again"))
        marks = found.repartition("__block").groupBy("__block").agg(F.bitmap_construct_agg("bit").alias("bits"), F.max("again").alias("again"))
        return own, self._stored(marks, path)

    def _marked(self, placed: DataFrame, marks: DataFrame, wanted: bool) -> DataFrame:
        """Rows with a mark at their place, or those without. The marks, one bit for each row of the files, go to every executor."""
        columns = [quoted(c) for c in placed.columns if c != "__place"]
        words = F.expr(f"transform(sequence(0, {(1 << _BLOCK_BITS - 6) - 1}), i -> cast(conv(hex(substring(bits, 8 * i + 1, 8)), 16, -10) as bigint))")
        of_block = F.broadcast(marks.select("__block", words.alias("__words")))
        word = F.shiftright("__place", 6).bitwiseAND(F.lit((1 << _BLOCK_BITS - 6) - 1)).cast("int")
        # A word's first byte is its highest.
        bit = F.getbit(F.get("__words", word), F.col("__place").bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56)).cast("int"))
        rows = placed.withColumn("__block", F.shiftright("__place", _BLOCK_BITS)).join(of_block, "__block", "left")
        return rows.where(F.coalesce(bit, F.lit(0).cast("tinyint")) == F.lit(int(wanted))).select(*columns)

    def forget(self, keep: int = 1) -> None:
        """Only the last ``keep`` versions can be read from now on; files that none of them names are deleted."""
        versions = self.versions()
        old, left = versions[:-keep], versions[-keep:]
        named = {f for v in left for f in self.files(v)}
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        there = listing.load(f"{self.path}/data").select(F.col("_metadata.file_path").alias("file")).collect()
        for v in old:
            remove(self.spark, f"{self.path}/lists/version={v}")
        for r in there:
            if r["file"] not in named:
                remove(self.spark, unquote(r["file"]))
