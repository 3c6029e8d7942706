"""Operator 7: token counts through a digest cache.

Counts are stored under (content digest, tokenizer digest). A run digests the
texts, looks the digests up, encodes each distinct text that is missing once,
appends its count to the cache, and joins counts back by digest. A run that
broke off costs nothing but its own appends; digests appended twice count once.

The content that is digested is the text as the tokenizer sees it, so null is
empty and nothing else may be folded: the tokenizers here normalise nothing
that could leave a count unchanged.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringside.llm.common import table, whole_text
from ringside.session import shared_dir

LIMIT = 4096
MEMO = 300_000
_CACHE = "content binary, tokenizer string, n_tokens bigint"


def tokenizer_digest(path: str) -> str:
    """Digest of the vocabulary file, with the library and its version."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"sentencepiece {sentencepiece.__version__}".encode()).hexdigest()


class PieceCounter:
    """Counts tokens of texts with the library, remembering the counts of recent segments.

    A segment is a run of spaces (as the model escapes them) with the characters
    after it. No piece of the model holds a space after another character, so no merge
    crosses from one segment to the next, and a text's count is the sum of its
    segments'. A model without that property, or with a normaliser of its own,
    is given whole texts.
    """

    SPACE = "▁"

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        as_is = self.model.encode("  a  éﬁ ", out_type=str)
        self.apart = not any(self.SPACE in p.lstrip(self.SPACE) for p in pieces) and \
            "".join(as_is) == f"{self.SPACE * 3}a{self.SPACE * 2}éﬁ{self.SPACE}"
        self.memo: dict[str, int] = {}
        self.segments = re.compile(f"{self.SPACE}+[^{self.SPACE}]*").findall

    def counts(self, texts: list[str]) -> list[int]:
        if not self.apart:
            return [len(x) for x in self.model.encode(texts, num_threads=1)]
        return [self._count(t) for t in texts]

    def _count(self, text: str) -> int:
        if not text:
            return 0
        parts = self.segments(self.SPACE + text.replace(" ", self.SPACE))
        memo = self.memo
        missing = set(parts).difference(memo)
        if missing:
            if len(memo) > MEMO:
                memo.clear()
                missing = set(parts)
            missing = list(missing)
            # the library puts the first space in front itself, but for an empty text
            for p, ids in zip(missing, self.model.encode([p[1:] for p in missing], num_threads=1)):
                memo[p] = len(ids) if len(p) > 1 else 1
        return sum(map(memo.__getitem__, parts))


_OPEN: dict[str, PieceCounter] = {}


def opened(path: str) -> PieceCounter:
    """The model, read once per Python worker."""
    if path not in _OPEN:
        _OPEN[path] = PieceCounter(path)
    return _OPEN[path]


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache at this path, begun if it isn't there yet; one row per content and tokenizer."""
    spark.createDataFrame([], _CACHE).write.mode("append").parquet(path)
    return spark.read.schema(_CACHE).parquet(path).groupBy("content", "tokenizer").agg(F.max("n_tokens").alias("n_tokens"))


def _encoded(misses: DataFrame, path: str) -> DataFrame:
    def count(batches):
        counter = opened(path)
        for pdf in batches:
            yield pd.DataFrame({"content": pdf["content"], "n_tokens": counter.counts(pdf["text"].tolist())})

    return misses.mapInPandas(count, "content binary, n_tokens bigint")


def count_tokens(docs: DataFrame, path: str, cache: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row; cache is a folder that all executors share.

    Null and empty texts have no tokens. Repeated rows come back as often as
    they came, and equal texts are encoded once. Whole texts are encoded, without
    begin, end or added special tokens; special strings are ordinary text.
    Other columns play no part; an empty table gives an empty one.
    """
    spark, version, t = docs.sparkSession, tokenizer_digest(path), whole_text(text)
    content = F.unhex(F.sha2(t, 256))
    known = open_cache(spark, cache).filter(F.col("tokenizer") == version).select("content")
    # one text per digest and task is sent, so a text with very many copies crosses the network few times
    texts = docs.select(content.alias("content"), t.alias("text")).groupBy("content").agg(F.first("text").alias("text"))
    misses = texts.join(known, "content", "left_anti")
    _encoded(misses, path).select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    stored = open_cache(spark, cache).filter(F.col("tokenizer") == version).drop("tokenizer")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.octet_length(t).cast("bigint").alias("n_bytes"),
                       content.alias("content"))
    return rows.join(stored, "content").select("doc_id", "n_bytes", "n_tokens")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7(spark, sf_dir):
    """Token counts of every document, through a cache that this run begins."""
    import uuid

    cache = f"{shared_dir(spark).rstrip('/')}/token-counts-{uuid.uuid4().hex}"
    out = count_tokens(table(spark, sf_dir, "documents"), model_path(), cache)
    return out.withColumn("over_limit", F.col("n_tokens") > LIMIT)


QUERIES = {"op7_token_counts": op7}
