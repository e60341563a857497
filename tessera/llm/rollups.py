"""Token totals kept up to date by signed changes.

Counts of documents become changes: +1 for an insert, -1 for a delete, and both for a revised
count. A batch of changes is summed by source, language and tokenizer version and committed
once under its id; totals are the sum of the committed batches.
"""

from __future__ import annotations

import base64
import uuid

import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import mapped

KEYS = ("source", "lang", "tokenizer")
MEASURES = ("n_docs", "n_tokens", "n_chars")
#: Vocabulary files of byte-level BPE tokenizers by version name.
TOKENIZERS = {"byte_bpe_50k": "/opt/tokenizers/byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"}
#: How byte-level BPE cuts text before merging: contractions, letters, digits, other marks, white space. Fixed value of these vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes of a vocabulary file, at most.
MAX_VOCABULARY = 64 * 1024 * 1024

_made: dict[str, tiktoken.Encoding] = {}


def _encoding(name: str, vocabulary: bytes) -> tiktoken.Encoding:
    """The tokenizer of a vocabulary file's content, made once in each worker."""
    if name not in _made:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        _made[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _made[name]


def _content(spark: SparkSession, path: str) -> bytes:
    """Content of one file, at most MAX_VOCABULARY bytes."""
    if "://" in path:
        found = spark.read.format("binaryFile").load(path).filter(F.col("length") <= MAX_VOCABULARY).select("content").first()
        if found is None:
            raise ValueError(f"no vocabulary file of at most {MAX_VOCABULARY} bytes at {path}")
        return bytes(found.content)
    with open(path, "rb") as f:
        return f.read()


def token_counts(docs: DataFrame, tokenizers: dict[str, str], *, text_col: str = "text", carry: tuple[str, ...] = ("doc_id", "source", "lang")) -> DataFrame:
    """The carried columns with tokenizer, n_tokens and n_chars: a row for each document and tokenizer.

    Whole texts are counted; null and empty texts have 0 tokens. The vocabulary files (about a
    megabyte each) are read once, a path with a scheme through Spark, and broadcast.
    """
    spark = docs.sparkSession
    held = {name: _content(spark, path) for name, path in tokenizers.items()}
    shared = spark.sparkContext.broadcast(held)
    names = list(held)

    def run(rows: pa.StructArray) -> list[pa.Array]:
        texts = [t or "" for t in pc.struct_field(rows, [text_col]).cast(pa.string()).to_pylist()]
        encoders = [_encoding(n, shared.value[n]).encode_ordinary for n in names]
        return [pa.array([[len(e(t)) for e in encoders] for t in texts], pa.list_(pa.int64())), pa.array([len(t) for t in texts], pa.int64())]

    found = mapped(docs, run, "tokens array<long>, n_chars long", list(carry))
    each = found.select("row", "n_chars", F.posexplode("tokens").alias("k", "n_tokens"))
    return each.select("row.*", F.get(F.array(*map(F.lit, names)), F.col("k")).alias("tokenizer"), "n_tokens", "n_chars")


def inserts(counts: DataFrame) -> DataFrame:
    """Changes that add the counts (source, lang, tokenizer, n_tokens, n_chars)."""
    return counts.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), F.col("n_tokens").cast("long").alias("n_tokens"), F.col("n_chars").cast("long").alias("n_chars"))


def deletes(counts: DataFrame) -> DataFrame:
    """Changes that take the counts away again."""
    return inserts(counts).select(*KEYS, *(F.negative(m).alias(m) for m in MEASURES))


def revisions(old: DataFrame, new: DataFrame, key: str = "doc_id") -> DataFrame:
    """Changes from old to new counts of the same documents: rows on one side only are inserts or deletes,
    equal rows cancel out before they are shuffled any further. Repeated keys count as often as they stand."""
    columns = [key, *KEYS, "n_tokens", "n_chars"]
    signed = new.select(*columns, F.lit(1).alias("sign")).unionByName(old.select(*columns, F.lit(-1).alias("sign")))
    net = signed.groupBy(*columns).agg(F.sum("sign").alias("sign")).filter("sign <> 0")
    return net.select(*KEYS, F.col("sign").alias("n_docs"), *((F.col(m) * F.col("sign")).cast("long").alias(m) for m in ("n_tokens", "n_chars")))


class TokenRollup:
    """Totals under one folder, kept by any number of writers without locks.

    deltas/<batch>/<attempt> holds the sums of one attempt at a batch, and commits a JSON row for each
    attempt that was finished, written last. A batch counts by exactly one of its finished attempts,
    so an attempt that broke off, a retried job and two writers of one batch change nothing. A
    compaction is a batch of sums that names all loaded batches it covers; of compactions that
    overlap the one that covers most counts, and what it covers does not count again.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _commits(self) -> dict[str, tuple[str, list[str]]]:
        """Attempt and covered batches of every committed batch; the list of batches, not their sums, is read."""
        kind = "batch string, attempt string, covers array<string>"
        try:
            rows = self.spark.read.schema(kind).json(f"{self.path}/commits")
        except AnalysisException:  # no commit yet
            return {}
        first = rows.groupBy("batch").agg(F.min(F.struct("attempt", "covers")).alias("c")).select("batch", "c.*")
        return {r.batch: (r.attempt, list(r.covers or [])) for r in first.collect()}

    def committed(self) -> set[str]:
        """Ids of all batches that ever were committed."""
        return set(self._commits())

    @staticmethod
    def _counting(commits: dict[str, tuple[str, list[str]]]) -> list[str]:
        """Batches whose sums add up to every loaded batch once."""
        covered: set[str] = set()
        out = []
        for batch, (_, covers) in sorted(commits.items(), key=lambda c: (-len(c[1][1]), c[0])):
            if covers and covered.isdisjoint(covers):
                covered |= set(covers)
                out.append(batch)
        return sorted(out + [b for b, (_, covers) in commits.items() if not covers and b not in covered])

    def _write(self, batch: str, changes: DataFrame, covers: list[str]) -> None:
        attempt = uuid.uuid4().hex
        sums = changes.groupBy(*KEYS).agg(*(F.sum(m).cast("long").alias(m) for m in MEASURES))
        sums.write.parquet(f"{self.path}/deltas/{batch}/{attempt}")
        mark = self.spark.createDataFrame([(batch, attempt, covers)], "batch string, attempt string, covers array<string>")
        mark.coalesce(1).write.mode("append").json(f"{self.path}/commits")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Sum the changes and add them under the id; False if the id is committed already."""
        if batch in self.committed():
            return False
        self._write(batch, changes, [])
        return True

    def _sums(self, commits: dict[str, tuple[str, list[str]]]) -> DataFrame:
        kind = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long"
        paths = [f"{self.path}/deltas/{b}/{commits[b][0]}" for b in self._counting(commits)]
        rows = self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)
        return rows.groupBy(*KEYS).agg(*(F.sum(m).cast("long").alias(m) for m in MEASURES)).filter(" or ".join(f"{m} <> 0" for m in MEASURES))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens, n_chars; groups whose documents are all gone are left out."""
        return self._sums(self._commits())

    def compact(self) -> str | None:
        """One batch in place of all that count now; its id, or None if there is at most one.

        The batches are listed once, and exactly those are summed and covered: what is committed
        meanwhile goes on counting for itself.
        """
        commits = self._commits()
        counting = self._counting(commits)
        if len(counting) < 2:
            return None
        covers = sorted({x for b in counting for x in (commits[b][1] or [b])})
        batch = f"compaction-{uuid.uuid4().hex}"
        self._write(batch, self._sums(commits), covers)
        return batch
