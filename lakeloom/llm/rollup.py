"""Token counts: delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed rows. An
insert adds a document's count, a delete takes away what the batch says it
had, a revised count does both. A batch is aggregated once, written as one
folder named after the batch, and counts as committed when Spark's writer has
finished that folder; a batch that was committed is not written again, and one
that broke off is written anew in full. Totals read all committed batches.
Compaction keeps a ledger of the names it sums up, so that a batch sent again
later is still known.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm._io import staged, text_batches
from lakeloom.session import checkpoint_dir

KEYS = ("source", "lang", "tokenizer")
MEASURES = ("n_docs", "n_tokens")
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


# -- token counts -----------------------------------------------------------

def space_tokens(text: Column) -> Column:
    """Words between ASCII white space; 0 for a null or empty text."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def piece_tokens(text: Column) -> Column:
    """Runs of ASCII letters, digits and code points from U+0080, and every
    other ASCII sign but white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+|[!-/:-@\\[-`{-~]")), F.lit(0)).cast("long")


def bpe_tokens(docs: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens) with a public BPE vocabulary (a .tiktoken file at a
    path that every executor has); null and empty texts have no tokens."""
    text_batches(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]):
        import tiktoken
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        for batch in batches:
            n = [len(encoding.encode_ordinary(t.as_py())) if t.is_valid else 0 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_tokens long")


# -- signed rows ------------------------------------------------------------

def _signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.select("source", "lang", "tokenizer", F.lit(sign).cast("long").alias("n_docs"),
                       (sign * F.col("n_tokens")).cast("long").alias("n_tokens"))


def inserts(rows: DataFrame) -> DataFrame:
    """Signed rows of new documents (source, lang, tokenizer, n_tokens)."""
    return _signed(rows, 1)


def deletes(rows: DataFrame) -> DataFrame:
    """Signed rows of documents that go, with the counts they were added by."""
    return _signed(rows, -1)


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed rows of documents whose count, source, language or tokenizer
    version changes."""
    return deletes(before).unionByName(inserts(after))


# -- the store --------------------------------------------------------------

class Rollup:
    """Committed batches below one folder of the shared file system.

    A folder counts as committed when Spark's writer has finished it. A batch
    made by ``compact`` carries the names it covers in its folder, in a table
    that is written before its rows: those names stay committed for good, and
    their own folders, whether they are still there or not, are read no more
    from the moment the sum is committed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _folder(self, batch: str) -> str:
        if not batch or not all(c.isalnum() or c in "-_." for c in batch) or batch[0] in "._":
            raise ValueError(f"a batch name has letters, digits, - _ and . only: {batch!r}")
        return f"{self.path}/{batch}"

    def _written(self, batch: str) -> bool:
        p, files = self._files(f"{self._folder(batch)}/_SUCCESS")
        return files.exists(p)

    def _names(self, path: str) -> list[str]:
        p, files = self._files(path)
        return sorted(s.getPath().getName() for s in files.listStatus(p) if s.isDirectory()) if files.exists(p) else []

    def _covered(self, batch: str) -> list[str]:
        """Names that a compacted batch stands for."""
        path = f"{self.path}/_covers/{batch}"
        p, files = self._files(f"{path}/_SUCCESS")
        return [r.batch for r in self.spark.read.schema("batch string").parquet(path).collect()] if files.exists(p) else []

    def _ledger(self) -> tuple[list[str], set[str]]:
        """Batches that are read, and all names that were ever committed."""
        written = [n for n in self._names(self.path) if n[0] not in "._" and self._written(n)]
        gone = {c for n in self._names(f"{self.path}/_covers") if n in written for c in self._covered(n)}
        return [n for n in written if n not in gone], gone.union(written)

    def committed(self, batch: str) -> bool:
        """Whether the batch counts, by its own folder or in a compacted one."""
        return self._written(batch) or batch in self._ledger()[1]

    def _write(self, batch: str, signed: DataFrame) -> None:
        total = signed.groupBy(*KEYS).agg(*(F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in MEASURES))
        # the totals are summed in all tasks; only what comes out, a row a key, goes to one file
        total.where("n_docs != 0 or n_tokens != 0").repartition(1).write.mode("overwrite").parquet(self._folder(batch))

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Add a batch of signed rows; False if it was committed before (its
        rows are then not even read), also if it was compacted since. Rows are
        summed by key in each task and again after one small shuffle; keys that
        cancel out are left out. Repeated rows count each. Null sources,
        languages and versions are keys of their own; null counts count as 0.
        An empty batch is committed as empty. One writer at a time."""
        if self.committed(batch):
            return False
        self._write(batch, signed)
        return True

    def batches(self) -> list[str]:
        """Committed batches that the totals are read from."""
        return self._ledger()[0]

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; keys without a document
        and without tokens are left out."""
        names = self.batches()
        if not names:
            return self.spark.createDataFrame([], DELTA)
        rows = self.spark.read.schema(DELTA).parquet(*(self._folder(n) for n in names))
        out = rows.groupBy(*KEYS).agg(*(F.sum(m).alias(m) for m in MEASURES))
        return out.where("n_docs != 0 or n_tokens != 0")

    def compact(self, batch: str, names: list[str]) -> None:
        """Put the sum of committed batches in their place, under a new name.

        The names covered (with all that those covered themselves) are written
        first, then the sum; from its commit on the totals read the sum and
        none of the parts. Folders of parts are removed last. Given again after
        a crash it does what is left. Names not committed are not covered."""
        if not self._written(batch):
            live, known = self._ledger()
            if batch in known:
                return  # compacted itself since
            names = [n for n in names if n in live and n != batch]
            every = sorted({*names, *(c for n in names for c in self._covered(n))})
            self.spark.createDataFrame([(n,) for n in every], "batch string").repartition(1).write.mode("overwrite").parquet(f"{self.path}/_covers/{batch}")
            rows = self.spark.read.schema(DELTA).parquet(*(self._folder(n) for n in names)) if names else self.spark.createDataFrame([], DELTA)
            self._write(batch, rows)
        for n in self._covered(batch):
            p, files = self._files(self._folder(n))
            files.delete(p, True)


# -- the registered history ---------------------------------------------------

def corpus_history(docs: DataFrame, labels: DataFrame, path: str | None = None) -> DataFrame:
    """Totals after a history of batches over all of ``docs``:

    1. insert every document, counted by the tokenizer ``space-1``;
    2. delete the documents that ``labels`` marks as low quality;
    3. revise the toxic ones that are left: they are counted by ``piece-2``
       from now on (a delete under the old version, an insert under the new);
    4. batches 1 and 3 are submitted once more, as after a lost answer.

    Null ids are never deleted or revised. Labels that repeat an id count
    once, the strictest one. Texts are counted whole, once.
    """
    spark = docs.sparkSession
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.min("quality") == 0, F.lit(False)).alias("low"), F.coalesce(F.max("toxic") == 1, F.lit(False)).alias("toxic"))
    counted = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                 F.col("lang").cast("string").alias("lang"), space_tokens(F.col("text")).alias("space"),
                                 piece_tokens(F.col("text")).alias("piece")), "counts").join(marks, "doc_id", "left")
    by = lambda rows, version, count: rows.select("source", "lang", F.lit(version).alias("tokenizer"), F.col(count).alias("n_tokens"))
    low, toxic = counted.where("low"), counted.where("toxic and not low")
    store = Rollup(spark, path or f"{checkpoint_dir(spark).rstrip('/')}/llm-rollup-{uuid.uuid4().hex}")
    history = {"0001-insert": inserts(by(counted, "space-1", "space")),
               "0002-delete": deletes(by(low, "space-1", "space")),
               "0003-revise": revisions(by(toxic, "space-1", "space"), by(toxic, "piece-2", "piece"))}
    for batch in [*history, "0001-insert", "0003-revise"]:
        store.commit(batch, history[batch])
    return store.totals()


ORACLE_SQL = r"""
WITH marks AS (SELECT doc_id, min(quality) = 0 AS low, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
alive AS (
  SELECT source, lang, text, coalesce(toxic, false) AS revised FROM documents LEFT JOIN marks USING (doc_id) WHERE NOT coalesce(low, false)),
counted AS (
  SELECT source, lang, CASE WHEN revised THEN 'piece-2' ELSE 'space-1' END AS tokenizer,
    len(regexp_extract_all(coalesce(text, ''), CASE WHEN revised THEN '[0-9A-Za-z\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]' ELSE '[^\x20\x09-\x0D]+' END)) AS n
  FROM alive)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM counted GROUP BY ALL
"""
