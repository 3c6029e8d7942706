"""Operator 6: SentencePiece encoding and decoding by batched Viterbi.

A text is cut into segments (a run of spaces and the characters after it); no
piece crosses from one into the next. Segments of equal length advance together:
for every end position, the codes of all substrings that end there are looked
up in the sorted codes of the pieces, and one vectorised maximum over the
piece lengths stores score and back pointer of each segment.

The best segmentation has the highest sum of piece scores (of a BPE model: the
fewest and earliest merges, its scores being ranks); of equal sums the one whose
last piece is longest wins. A character in no piece becomes its UTF-8 bytes.
Decoding gives back exactly the text that was encoded: unlike the library, a
literal U+2581 in a text is encoded by its bytes and so stays apart from a space.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringside.llm.common import table, whole_text
from ringside.llm.token_counts import model_path

SPACE = 0x2581
#: Stands for a literal U+2581: a number that no character and no piece has.
_LITERAL = 0x110000
#: Segments whose ids a task remembers, and characters worked on at a time.
MEMO = 200_000
BLOCK = 1 << 17
_FALLBACK = -1
_SEGMENTS = re.compile(" +[^ ]*").findall
_FILTER_BITS = 22

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


_POWERS: dict = {}


def _powers(which: int, inverse: bool, n: int) -> np.ndarray:
    """0th, 1st, ... power of the base (or its inverse) modulo 2^64, at least n of them."""
    have = _POWERS.get((which, inverse))
    if have is None or len(have) < n:
        base = int(_ODD[which])
        out = np.full(max(1024, 2 * n), pow(base, -1, 1 << 64) if inverse else base, np.uint64)
        out[0] = 1
        have = _POWERS[which, inverse] = np.multiply.accumulate(out)
    return have


def _inverse(which: int, n: int) -> np.ndarray:
    return _powers(which, True, n + 1)


def _prefixes(points: np.ndarray, which: int) -> np.ndarray:
    """Running sums, down each column of code points, of code point times power of the base."""
    n, m = points.shape
    out = np.zeros((n + 1, m), np.uint64)
    np.cumsum((points + np.uint64(1)) * _powers(which, False, n)[:n, None], axis=0, out=out[1:])
    return out


def _codes(prefix: np.ndarray, end: int, starts: np.ndarray, which: int) -> np.ndarray:
    """Codes of the substrings from each start to end, a row for each start: the same wherever a substring stands."""
    sums = (prefix[end] - prefix[starts]) * _inverse(which, end)[starts][:, None]
    return _mixed(sums ^ (end - starts).astype(np.uint64)[:, None])


class Pieces:
    """The vocabulary as sorted piece codes, with scores and ids beside them."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        names = {i: model.id_to_piece(i) for i in range(size) if not special(i)}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, names.values()))
        ids = np.fromiter(names, np.int64, len(names))
        codes = np.zeros((2, len(ids)), np.uint64)
        lengths = np.array([len(p) for p in names.values()])
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            points = np.array([[ord(c) for c in names[ids[i]]] for i in at], np.uint64).T
            for w in (0, 1):
                codes[w, at] = _codes(_prefixes(points, w), n, np.array([0]), w)[0]
        order = np.argsort(codes[0], kind="stable")
        self.keys, self.check, self.ids = codes[0][order], codes[1][order], ids[order]
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces have one code")
        self.scores = np.array([model.get_score(int(i)) for i in self.ids])
        # pieces of spaces alone bear no rank (-1e9); they cost little less than a character by its bytes
        ranked = self.scores > -1e8
        self.unknown = self.scores[ranked].min() - 10
        self.scores[~ranked] = self.unknown + 1
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self.keys >> np.uint64(64 - _FILTER_BITS)] = True
        self.spelled = [b""] * size
        for i, p in names.items():
            self.spelled[i] = p.replace(chr(SPACE), " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.spelled[i] = bytes([b])
        self.memo: dict[str, bytes] = {}

    def _look_up(self, prefixes, end: int, starts: np.ndarray):
        """Which substrings from the starts to end are pieces: row, column, place in the sorted codes."""
        code = _codes(prefixes[0], end, starts, 0)
        rows, columns = np.nonzero(self.maybe[code >> np.uint64(64 - _FILTER_BITS)])
        wanted = code[rows, columns]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        ok = np.flatnonzero(self.keys[at] == wanted)
        rows, columns, at = rows[ok], columns[ok], at[ok]
        first = starts[rows]
        again = _mixed(((prefixes[1][end, columns] - prefixes[1][first, columns]) * _inverse(1, end)[first])
                       ^ (end - first).astype(np.uint64))
        ok = np.flatnonzero(self.check[at] == again)
        return rows[ok], columns[ok], at[ok]

    def viterbi(self, points: np.ndarray) -> list[np.ndarray]:
        """Ids of the best segmentation of each column (columns: segments of one length, as code points)."""
        n, m = points.shape
        prefixes = [_prefixes(points, w) for w in (0, 1)]
        best = np.full((n + 1, m), -np.inf)
        best[0] = 0
        piece = np.full((n + 1, m), _FALLBACK, np.int32)
        back = np.ones((n + 1, m), np.int32)
        column = np.arange(m)
        for end in range(1, n + 1):
            # the longest piece comes first, so that it wins a tie; the last row is the way by bytes
            starts = np.arange(max(0, end - self.longest), end)
            score = np.full((len(starts) + 1, m), -np.inf)
            found = np.full((len(starts) + 1, m), _FALLBACK, np.int32)
            rows, columns, at = self._look_up(prefixes, end, starts)
            score[rows, columns] = best[starts[rows], columns] + self.scores[at]
            found[rows, columns] = self.ids[at]
            score[-1] = best[end - 1] + self.unknown
            take = score.argmax(0)
            best[end], piece[end] = score[take, column], found[take, column]
            back[end] = np.where(take == len(starts), 1, len(starts) - take)
        return self._followed(points, piece, back)

    def _followed(self, points, piece, back):
        n, m = points.shape
        at, steps, column = np.full(m, n), [], np.arange(m)
        while (at > 0).any():
            # -2: this segment has ended; -3 - c: the bytes of c
            ids = np.where(at > 0, piece[at, column], -2).astype(np.int64)
            ids = np.where(ids == _FALLBACK, -3 - points[np.maximum(at - 1, 0), column].astype(np.int64), ids)
            steps.append(ids)
            at = np.where(at > 0, at - back[at, column], 0)
        path = np.stack(steps[::-1], axis=1)
        on = path != -2
        out = np.split(path[on], np.cumsum(on.sum(1))[:-1])
        for i in np.flatnonzero((path < -2).any(1)):
            out[i] = self._spell(out[i])
        return out

    def _spell(self, row: np.ndarray) -> np.ndarray:
        out: list[int] = []
        for x in row.tolist():
            if x >= 0:
                out.append(x)
            else:
                c = -3 - x
                out += [self.byte_ids[b] for b in chr(SPACE if c == _LITERAL else c).encode()]
        return np.array(out, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts; an empty text has none."""
        cut = [_SEGMENTS(" " + t) if t else [] for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        by_length: dict[int, list[str]] = {}
        for s in {s for segments in cut for s in segments}.difference(self.memo):
            by_length.setdefault(len(s), []).append(s)
        for n, new in by_length.items():
            for i in range(0, len(new), max(1, BLOCK // n)):
                block = new[i:i + max(1, BLOCK // n)]
                points = np.frombuffer("".join(block).encode("utf-32-le"), "<u4").reshape(-1, n).T.astype(np.uint64)
                points[points == SPACE] = _LITERAL
                points[points == 32] = SPACE
                for s, ids in zip(block, self.viterbi(points)):
                    self.memo[s] = ids.astype("<i4").tobytes()
        return [np.frombuffer(b"".join(map(self.memo.__getitem__, segments)), "<i4") for segments in cut]

    def decode(self, ids) -> str:
        """The text of these ids; bytes that are no UTF-8 become U+FFFD."""
        spelled = self.spelled
        return b"".join([spelled[i] for i in ids])[1:].decode("utf-8", "replace")


_OPEN: dict[str, Pieces] = {}


def opened(path: str) -> Pieces:
    """The vocabulary, read once per Python worker."""
    if path not in _OPEN:
        _OPEN[path] = Pieces(path)
    return _OPEN[path]


_BATCH = 256


def decoded(ids: Column, path: str) -> Column:
    """The texts of an array<int> column."""
    @F.pandas_udf("string")
    def of(rows: pd.Series) -> pd.Series:
        pieces = opened(path)
        return pd.Series([pieces.decode(r.tolist()) for r in rows], dtype=object)

    return of(ids)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", back: bool = False) -> DataFrame:
    """(doc_id, text, ids) of every row, repeated rows included; with back, decoded too: the text of the ids.

    A null text counts as empty and has no ids. Other columns play no part.
    Texts are worked on a few at a time, whatever the size of a batch.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(text).alias("text"))

    def of(batches):
        pieces = opened(path)
        for batch in batches:
            for i in range(0, batch.num_rows, _BATCH):
                part = batch.slice(i, _BATCH)
                ids = pieces.encode(part.column(1).to_pylist())
                ends = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32))
                out = [part.column(0), part.column(1), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids)))]
                if back:
                    out.append(pa.array([pieces.decode(x.tolist()) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "text", "ids", "decoded"][:len(out)])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(of, f"doc_id {kind}, text string, ids array<int>" + ", decoded string" * back)


def op6(spark, sf_dir):
    """Every document encoded and decoded again."""
    rows = encode(table(spark, sf_dir, "documents"), model_path(), back=True)
    return rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"),
                       F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.col("decoded") == F.col("text")).alias("round_trip"))


QUERIES = {"op6_sentencepiece_viterbi": op6}
