"""Line dedup by winnowing over line hashes.

A window is the shortest stretch of lines from a line on that has ``run_lines``
lines or ``run_words`` words.  The smallest line hash of each window is its
fingerprint, so every repeated run that fills a window shares a fingerprint.
Fingerprints that occur once are put aside; for the others all windows around
them, to both sides, are compared with the first place of the same lines, and
what stands later is deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirestream.llm.common import spare, stage

RUN_LINES = 3
RUN_WORDS = 50
#: Stands for a missing id: such rows come after all others.
LAST = (1 << 63) - 1


def numbered_lines(text: str) -> list[tuple[int, bytes, int]]:
    """``(line number, line, words)`` of the lines that have a word."""
    out = []
    for i, line in enumerate(text.encode("utf-8").split(b"\n")):
        n = len(line.split())
        if n:
            out.append((i, line, n))
    return out


def windows_of(words: list[int], run_lines: int, run_words: int) -> Iterator[tuple[int, int]]:
    """``(first, behind the last)`` of each full window over lines with the given numbers of words."""
    for a in range(len(words)):
        total = 0
        for b in range(a, min(a + run_lines, len(words))):
            total += words[b]
            if total >= run_words or b - a + 1 == run_lines:
                yield a, b + 1
                break


def fingerprints(docs: DataFrame, run_lines: int, run_words: int) -> DataFrame:
    """``(fp, doc, row, windows)``: each fingerprint line with the windows that chose it.

    ``docs`` has ``doc, row, text``; a window is ``(k1, k2, line, stop)``: a hash of
    its lines, and the line numbers it spans.
    """
    window = pa.list_(pa.struct([("k1", pa.int64()), ("k2", pa.int64()), ("line", pa.int32()), ("stop", pa.int32())]))

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, row, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lines = numbered_lines(text)
                hashes = [xxhash.xxh3_64_intdigest(x[1]) for x in lines]
                chosen: dict[int, list] = {}
                for a, b in windows_of([x[2] for x in lines], run_lines, run_words):
                    at = min(range(a, b), key=hashes.__getitem__)
                    k = xxhash.xxh3_128_intdigest(b"\n".join(x[1] for x in lines[a:b]))
                    chosen.setdefault(at, []).append({
                        "k1": signed(k >> 64), "k2": signed(k & ((1 << 64) - 1)), "line": lines[a][0], "stop": lines[b - 1][0] + 1})
                out += [(signed(hashes[at]), doc, row, ws) for at, ws in chosen.items()]
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), window))],
                ["fp", "doc", "row", "windows"])

    return docs.select("doc", "row", "text").mapInArrow(
        run, "fp long, doc long, row long, windows array<struct<k1: long, k2: long, line: int, stop: int>>")


def repeated_runs(docs: DataFrame, run_lines: int, run_words: int) -> DataFrame:
    """``(doc, row, line, stop)``: windows that also stand at an earlier place (document, then line)."""
    found = stage(fingerprints(docs, run_lines, run_words), "fingerprints")
    # written out, so that both joins shuffle plain tables and hot keys can be split
    common = stage(found.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp"), "common-lines")
    places = stage(found.join(common, "fp", "left_semi").select("doc", "row", F.inline("windows")), "windows")
    first = places.groupBy("k1", "k2").agg(F.min(F.struct("doc", "row", "line")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = stage(first.where("n > 1").select("k1", "k2", "first"), "first-places")
    later = places.join(first, ["k1", "k2"]).where(
        F.struct("doc", "row", "line") > F.col("first"))
    return later.select("doc", "row", "line", "stop")


_CUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()),
                     T.StructField("removed", T.ArrayType(T.IntegerType()))])


@F.pandas_udf(_CUT)
def without_runs(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
    """Texts without the lines in the runs; lines without a word stay."""
    out = []
    for text, spans in zip(texts, runs):
        worded = {i for i, _, _ in numbered_lines(text)}
        gone = worded.intersection(i for r in spans for i in range(r["line"], r["stop"]))
        kept = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone) if gone else ""
        out.append((kept, len(worded), sorted(gone)))
    return pd.DataFrame(out, columns=["text", "n_lines", "removed"])


def dedup_lines(docs: DataFrame, run_lines: int = RUN_LINES, run_words: int = RUN_WORDS, out: str = "lines",
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the later repeated runs of lines deleted from the text, and a struct ``out``.

    ``out`` has ``n_lines`` (lines with a word), ``n_removed`` and ``removed`` (their
    line numbers).  A run of whole lines with ``run_lines`` lines or ``run_words``
    words is deleted where the same lines stand earlier: in a smaller id or further
    up; runs are judged on the input.  Lines without a word are not compared and
    stay.  A NULL text stays NULL, an empty one empty.  Rows without id come last;
    equal rows count as one place, so repeated rows all keep their lines.  A column
    named ``out`` is replaced; other extra columns pass through.
    """
    doc, text = F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(LAST)), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    row = F.xxhash64(text)
    runs = repeated_runs(docs.select(doc.alias("doc"), row.alias("row"), text.alias("text")), run_lines, run_words)
    d, r, spans, done = spare(docs, "__doc", "__row", "__runs", "__cut")
    per = runs.groupBy("doc", "row").agg(F.collect_set(F.struct("line", "stop")).alias(spans)).select(
        F.col("doc").alias(d), F.col("row").alias(r), spans)
    joined = docs.join(per, (doc == F.col(d)) & (row == F.col(r)), "left")
    cut = without_runs(text, F.coalesce(spans, F.array().cast("array<struct<line: int, stop: int>>")))
    cut = joined.withColumn(done, cut)
    removed = F.size(f"{done}.removed")
    kept = F.when(removed == 0, F.col(f"`{text_col}`")).otherwise(F.col(f"{done}.text"))
    info = F.struct(f"{done}.n_lines", removed.cast("bigint").alias("n_removed"), f"{done}.removed").alias(out)
    cols = [kept.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != out]
    return cut.select(*cols, info)
