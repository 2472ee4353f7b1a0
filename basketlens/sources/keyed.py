"""Tables laid out for looking up few keys: ranges of the key, a Bloom filter per row group."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketlens.functions.sql import named
from basketlens.sources.commits import CommitLog

#: So many keys reach the scan as equalities, which row group statistics and Bloom filters answer.
PUSHED_KEYS = 200
GROUP_BYTES = 8 << 20
GROUP_ROWS = 100_000


@dataclass(frozen=True)
class KeyedTable:
    """A table of which mostly the rows of few keys are read.

    Rows are put in ranges of ``key``, a file or more each, sorted inside. A list of the files
    with their smallest and largest key lies beside them, so a lookup opens only files that can
    hold a key, whatever the size of the table. Replacing writes a new folder and commits it:
    readers of the old one go on undisturbed. Rows without a key are kept but never looked up.
    """

    spark: SparkSession
    root: str
    key: str

    @property
    def _log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root.rstrip('/')}/commits")

    def replace(self, df: DataFrame, ranges: int | None = None) -> None:
        """Write ``df``, in ``ranges`` ranges or as many as its size suggests at run time."""
        folder = uuid.uuid4().hex
        path = f"{self.root.rstrip('/')}/{folder}"
        placed = df.repartitionByRange(*([ranges] if ranges else []), F.col(self.key)).sortWithinPartitions(self.key)
        (
            placed.write.option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{self.key}", GROUP_ROWS)
            .option("parquet.block.size", GROUP_BYTES)
            .option("parquet.block.row.count.limit", GROUP_ROWS)
            .parquet(f"{path}/rows")
        )
        written = self.spark.read.schema(df.schema).parquet(f"{path}/rows")
        files = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            *named(low=f"min(`{self.key}`)", high=f"max(`{self.key}`)", rows="count(1)")
        )
        files.coalesce(1).write.parquet(f"{path}/files")
        self._log.commit(lambda: {"folder": folder, "schema": df.schema.json()})

    def _current(self) -> tuple[str, StructType]:
        found = self._log.read("commit long, folder string, schema string").orderBy(F.col("commit").desc()).first()
        if found is None:
            raise LookupError(f"nothing was written to {self.root}")
        return f"{self.root.rstrip('/')}/{found['folder']}", StructType.fromJson(json.loads(found["schema"]))

    def read(self) -> DataFrame:
        path, schema = self._current()
        return self.spark.read.schema(schema).parquet(f"{path}/rows")

    def lookup(self, asked: DataFrame) -> DataFrame:
        """All rows whose key occurs in ``asked``, each once however often it is asked for.

        Which files can hold a key is settled here, by a job over ``asked``; the result reads
        those. Up to ``PUSHED_KEYS`` keys are compared inside the scan; more are joined, and
        then ``asked`` is read again. Both ways give the same rows.
        """
        path, schema = self._current()
        keys = asked.select(F.col(self.key)).filter(F.col(self.key).isNotNull()).distinct()
        files = self.spark.read.parquet(f"{path}/files").filter("low IS NOT NULL")
        few = [r[0] for r in keys.limit(PUSHED_KEYS + 1).collect()]
        if len(few) <= PUSHED_KEYS:
            touched = files.filter(_either([F.lit(k).between(F.col("low"), F.col("high")) for k in few]))
        else:
            listed = files.agg(F.expr("collect_list(struct(low, high, file))")).scalar()
            held = f"filter(__files, f -> `{self.key}` BETWEEN f.low AND f.high)"
            touched = keys.withColumn("__files", listed).selectExpr(f"explode({held}.file) AS file").distinct()
        paths = sorted(f"{path}/rows/{r['file']}" for r in touched.select("file").collect())
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*paths)
        if len(few) <= PUSHED_KEYS:
            return rows.filter(_either([F.col(self.key) == F.lit(k) for k in few]))
        return rows.join(keys, self.key, "left_semi").select(*schema.names)


def _either(conditions: list[Column]) -> Column:
    """Whether one of the conditions holds, as a balanced tree; false for none."""
    if not conditions:
        return F.lit(False)
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _either(conditions[:half]) | _either(conditions[half:])
