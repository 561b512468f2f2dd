"""Token totals by source, language and tokenizer version, kept up by signed changes in batches.

A change feed has one row per event: `change` is 'insert', 'delete' or 'revise', with the document's source, language and
tokenizer version, its counts, and for a revision the counts it had before (`old_tokens`, `old_chars`). Every event is
additive: an insert adds, a delete takes away, a revision adds the difference, so totals never need the documents
again. A batch is summed by group (partial sums in each task, so no source crowds one), and the sums are written
as Parquet to a staged folder. The batch is committed by renaming that folder, whole as it is, to the name made from
the batch's id; renaming fails if the name is taken, so of two writers, retries or replays of a batch exactly one
counts and the others change nothing. A writer that dies leaves a staged folder that nobody reads, and the
batch can be applied again. The folder must be on a file system that renames folders in one step.

Totals are the sums over the committed batches. `compact` commits sums that stand for all batches it saw, under the number after the
newest compaction's: of two compactions that saw the same, one gets the number and the other changes nothing, and a batch
committed meanwhile is not among those it stands for and goes on counting by itself. The newest compaction
and the batches it does not stand for are all that totals read; a batch's name stays for as long as replays must be known.

Null sources and languages are groups of their own; null counts are 0; repeated events count as often as they come;
an empty batch is committed without rows. Unknown changes raise an error when the batch is computed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import vocab

GROUP = ("source", "lang", "tokenizer")
TOTALS = ("n_docs", "n_tokens", "n_chars")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long"


def token_count(text: Column, vocabulary: str | None = None) -> Column:
    """Tokens of a whole text by a rank vocabulary, its added token as one; null texts have none."""
    path = vocabulary or vocab.vocabulary_path(vocab.BYTE_BPE_RANKS)

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = partial(vocab.rank_encoder(path).encode, allowed_special="all")
        for texts in batches:
            yield pd.Series([len(encode(text)) for text in texts], dtype="int64")

    return counted(F.coalesce(text.cast("string"), F.lit("")))


def summed(changes: DataFrame) -> DataFrame:
    """Signed sums of a change feed by group; groups whose changes cancel out are kept at 0."""
    sign = (
        F.when(F.col("change") == "insert", 1).when(F.col("change") == "delete", -1).when(F.col("change") == "revise", 0)
        .otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("change", F.lit("null")))).cast("int"))
    )

    def delta(new: str, old: str) -> Column:
        value = F.coalesce(F.col(new), F.lit(0)).cast("long")
        return F.when(F.col("change") == "revise", value - F.coalesce(F.col(old), F.lit(0)).cast("long")).otherwise(sign * value)

    rows = changes.select(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("tokenizer").cast("string").alias("tokenizer"),
        sign.cast("long").alias("n_docs"), delta("n_tokens", "old_tokens").alias("n_tokens"), delta("n_chars", "old_chars").alias("n_chars"),
    )
    return rows.groupBy(*GROUP).agg(*[F.sum(name).alias(name) for name in TOTALS])


class Rollup:
    """The committed batches below a folder that the driver and all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        self._path = hadoop.Path
        self._files = self._path(self.folder).getFileSystem(conf)
        self._names = hadoop.FileContext.getFileContext(self._files.makeQualified(self._path(self.folder)).toUri(), conf)
        kind = getattr(hadoop, "Options$Rename")
        self._keep = spark.sparkContext._gateway.new_array(kind, 1)
        self._keep[0] = kind.NONE

    def _batch(self, batch: str) -> str:
        return f"{self.folder}/batches/b{batch.encode().hex()}"

    def _listed(self, part: str) -> list[str]:
        root = self._path(f"{self.folder}/{part}")
        return [status.getPath().getName() for status in self._files.listStatus(root)] if self._files.exists(root) else []

    def _newest(self) -> tuple[int, list[str], list[str]]:
        """Number of the newest compaction, the ids of all compactions, and the batch folders it stands for."""
        number = max((int(name[1:]) for name in self._listed("compacted")), default=0)
        if not number:
            return 0, [], []
        lines = self.spark.read.text(self._covered(f"{self.folder}/compacted/g{number}")).collect()  # one line
        entry = json.loads(lines[0]["value"])
        return number, entry["ids"], entry["batches"]

    @staticmethod
    def _covered(folder: str) -> str:
        return f"{folder}/covered/list.json"

    def committed(self) -> list[str]:
        return sorted([bytes.fromhex(name[1:]).decode() for name in self._listed("batches")] + self._newest()[1])

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Sum and commit a batch; False, and nothing changes, if its id is committed already."""
        if self._files.exists(self._path(self._batch(batch))) or batch in self._newest()[1]:
            return False
        return self._commit(self._batch(batch), summed(changes))

    def _commit(self, place: str, sums: DataFrame, covered: dict | None = None) -> bool:
        staged = f"{self.folder}/staged/{uuid.uuid4().hex}"
        sums.write.parquet(f"{staged}/sums")
        if covered is not None:
            out = self._files.create(self._path(self._covered(staged)), False)
            out.write(bytearray(json.dumps(covered).encode()))
            out.close()
        target = self._path(place)
        self._files.mkdirs(target.getParent())
        try:
            self._names.rename(self._path(staged), target, self._keep)  # fails if another writer was first
        except Exception as error:
            if not self._files.exists(target):
                raise error
            self._files.delete(self._path(staged), True)
            return False
        return True

    def _counting(self) -> tuple[list[str], int, list[str], list[str]]:
        """Folders of sums that count, the newest compaction's number and ids, and all batch folders, from one look at each list."""
        number, ids, old = self._newest()  # before the batches: what it stands for is among them
        batches = self._listed("batches")
        newer = sorted(set(batches) - set(old))
        folders = [f"{self.folder}/compacted/g{number}/sums"] if number else []
        return folders + [f"{self.folder}/batches/{name}/sums" for name in newer], number, ids, sorted(batches)

    def _sums(self, folders: list[str]) -> DataFrame:
        rows = self.spark.read.schema(SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], SCHEMA)
        return rows.groupBy(*GROUP).agg(*[F.sum(name).alias(name) for name in TOTALS])

    def totals(self) -> DataFrame:
        """Sums over the committed batches by group."""
        return self._sums(self._counting()[0])

    def compact(self, batch: str) -> bool:
        """Put one set of sums in the place of all that count now; ids of batches it stands for stay committed.

        False, and nothing changes, if the id is committed already or another compaction came first."""
        folders, number, ids, batches = self._counting()
        if batch in ids or self._batch(batch).rsplit("/", 1)[1] in batches:
            return False
        return self._commit(f"{self.folder}/compacted/g{number + 1}", self._sums(folders), {"ids": [*ids, batch], "batches": batches})
