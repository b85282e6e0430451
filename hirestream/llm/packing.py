"""Best-fit packing of token sequences by the sum-of-squares rule.

Documents are tokenised in Arrow batches; what is packed are narrow rows of
lengths.  A place for a piece is chosen so that the sum over all residual gaps of
the squared number of open bins with that gap becomes smallest.  The rule is
applied per packing group; groups are hash shares of the pieces whose number
follows the corpus, so no task sees more than its share.  A group's last bins,
which may stay partly empty, are packed again with those of other groups.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirestream.llm.common import stage

#: Words for which lower-casing and normalisation are plain: visible ASCII and Latin letters.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: Pre-tokens of the word-level vocabulary (fixed by its file), for plain words in lower case.
PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
END_ID = 1
GROUP_BINS = 2048
GROUP_PIECES = 40_000
BUCKET = 1 << 32


@lru_cache(maxsize=1)
def _byte_alphabet() -> list[str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class _Remembered(dict):
    """Results of a function of words, up to a number of them."""

    def __init__(self, of: Callable[[bytes | str], bytes], bound: int):
        super().__init__()
        self.of, self.bound = of, bound

    def __missing__(self, word: bytes | str) -> bytes:
        if len(self) >= self.bound:
            self.clear()
        out = self[word] = self.of(word)
        return out


class WordTokens:
    """Token ids of a text, by word, as the tokenizer gives them for the whole text.

    White space separates pre-tokens and is dropped, so a text's ids are those of
    its words in turn.  Plain words are cut into pre-tokens here and only new
    pre-tokens go to the model; all other words go through the whole tokenizer.
    """

    def __init__(self, path: str, bound: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Remembered(self._word, bound)
        self.parts = _Remembered(self._part, bound)

    def _part(self, part: str) -> bytes:
        mapped = part if part.isascii() else "".join(map(_byte_alphabet().__getitem__, part.encode()))
        ids = [t.id for t in self.model.tokenize(mapped)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if PLAIN.fullmatch(text) and not (b"<" in word and any(s in text for s in self.specials)):
            out = b"".join(map(self.parts.__getitem__, PRE_TOKEN.findall(text.lower())))
        else:
            out = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return out

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        return b"".join(map(self.words.__getitem__, text.encode("utf-8").split()))


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = END_ID,
                     id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``(doc_id, row_key, piece, start, length, ids_crc32[, ids])``.

    A document is its ids and ``end_id``.  Documents longer than ``capacity`` are
    cut into pieces of that length, the last being the rest.  NULL and blank texts
    give one piece with the end id alone.  Repeated rows give their pieces again;
    ``row_key`` (a hash of the row's id and text) spreads rows over groups.
    """
    schema = "doc_id bigint, row_key bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    if with_ids:
        schema += ", ids binary"
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(tokenizer)
        for batch in batches:
            cols: list[list] = [[] for _ in range(7 if with_ids else 6)]
            for doc, key, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids = tokens.ids(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row = [doc, key, piece, at // 4, len(part) // 4, zlib.crc32(part), part]
                    for c, v in zip(cols, row):
                        c.append(v)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "row_key", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names[: len(cols)])

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    doc = F.col(f"`{id_col}`")
    return docs.select(doc.alias("doc_id"), F.xxhash64(doc, text).alias("row_key"), text.alias("text")).mapInArrow(
        cut, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and the residual gap of every bin.

    Items are placed in the given order.  Placing an item of size s into a bin
    with gap g changes the sum of squares by ``2 N(g-s) + 1 - (2 N(g) - 1)``; a new
    bin counts as gap ``capacity`` with no open bin, and closed bins (gap 0) do
    not count.  Among equal changes the smallest gap wins.
    """
    n_open = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    gaps: list[int] = []
    none = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        had = n_open[s:]
        change = 2 * n_open[: capacity + 1 - s] - 2 * had + 2
        change[0] = 1 - 2 * had[0]  # closes the bin: it leaves the sum
        fits = np.where(had > 0, change, none)
        left = capacity - s
        fresh = 2 * int(n_open[left]) + 1 if left else 0
        at = int(fits.argmin())
        if fits[at] < none and fits[at] <= fresh:
            gap = at + s
            b = stacks[gap].pop()
            n_open[gap] -= 1
        else:
            gap = capacity
            b = len(gaps)
            gaps.append(capacity)
        bins[i], offsets[i] = b, capacity - gap
        gaps[b] = gap - s
        if gap > s:
            stacks[gap - s].append(b)
            n_open[gap - s] += 1
    return bins, offsets, np.array(gaps, np.int64)


def _pack_groups(pieces: DataFrame, capacity: int) -> DataFrame:
    """Packs the rows of every ``grp``; adds ``sequence_id``, ``offset`` and ``gap`` (of the sequence)."""
    schema = "grp long, doc_id long, row_key long, piece int, start long, length long, ids_crc32 long, " \
             "sequence_id long, offset long, gap long"

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # longest first; the other columns only make the order the same in every run
        pdf = pdf.sort_values(["length", "row_key", "doc_id", "piece"], ascending=[False, True, True, True],
                              kind="stable", ignore_index=True)
        bins, offsets, gaps = sum_of_squares(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = bins + key[0] * BUCKET
        pdf["offset"] = offsets
        pdf["gap"] = gaps[bins]
        return pdf[[c.split()[0] for c in schema.split(", ")]]

    cols = ["grp", "doc_id", "row_key", "piece", "start", "length", "ids_crc32"]
    return pieces.select(*cols).groupBy("grp").applyInPandas(pack, schema)


def pack_pieces(pieces: DataFrame, capacity: int = 4096, group_bins: int = GROUP_BINS,
                group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; every sequence holds at most ``capacity`` tokens.

    The number of groups is what the counts of tokens and of pieces ask for.
    Sequences of the first pass that are not nearly full are taken apart and
    packed once more in fewer, larger shares.  An empty table gives no rows.
    """
    tokens, rows = pieces.agg(F.sum("length"), F.count(F.lit(1))).first()
    groups = max(1, -(-(tokens or 0) // (capacity * group_bins)), -(-rows // group_pieces))
    share = F.pmod(F.xxhash64("row_key", "doc_id", "piece"), F.lit(groups))
    first = _pack_groups(pieces.withColumn("grp", share), capacity)
    if groups == 1:
        return first.drop("grp", "gap", "row_key")
    first = stage(first, "packed")
    open_bins = F.col("gap") > capacity // 64
    loose = first.where(open_bins)
    left = loose.select("sequence_id").distinct().count()
    again = max(1, -(-left // group_bins))
    second = _pack_groups(
        loose.withColumn("grp", F.lit(groups) + F.pmod(F.xxhash64("sequence_id"), F.lit(again))), capacity)
    return first.where(~open_bins).unionByName(second).drop("grp", "gap", "row_key")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise and pack: ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece.

    NULL and blank texts are one token (the end id); a NULL id stays NULL; extra
    columns are ignored; repeated rows are packed as often as they occur.
    """
    pieces = stage(tokenized_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    return pack_pieces(pieces, capacity)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = END_ID,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed token sequences ``(sequence_id, ids array<int>)``; a sequence has at most ``capacity`` ids.

    For tables whose ids are unique.  Rows are gathered per sequence only.
    """
    ids = tokenized_pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids=True)
    joined = packed.select("doc_id", "piece", "sequence_id", "offset").join(
        ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"])

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"sequence_id": pdf["sequence_id"],
                                "ids": [np.frombuffer(x, "<u4").astype("i4") for x in pdf["ids"]]})

    whole = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    blob = F.aggregate("p", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"])).alias("ids")
    return whole.select("sequence_id", blob).mapInPandas(put, "sequence_id long, ids array<int>")
