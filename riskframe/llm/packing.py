"""Best-fit packing of token pieces into sequences of bounded length, by minimum bin slack.

Only the counts of the lengths decide how sequences are filled, and there are at most
``capacity`` lengths. For each kind of sequence a subset-sum table over the lengths still
there, one bitset of sums per copy added, finds the fullest combination that holds the
longest of them; the combination is removed as often as its copies allow, which uses up
at least one length. So there are at most ``capacity`` kinds, whatever the number of
documents. Spark encodes the texts, counts the lengths and gives each piece its place: the
rank of a piece among those of its length decides its sequence and offset.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, stage, text_of
from riskframe.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, place long"


def fullest(counts: dict[int, int], capacity: int) -> Counter:
    """The fullest combination of the counted lengths that holds the longest of them.

    Longer lengths are tried first, and the table ends with the first full combination.
    Bit s of a row tells that some of the copies so far sum to s; a length's copies enter
    as powers of two.
    """
    longest = max(counts)
    room = capacity - longest
    sums, rows, within = 1, [], (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        copies = min(counts[length] - (length == longest), room // length)
        power = 1
        while copies > 0 and not sums >> room:
            take = min(power, copies)
            rows.append((length, take, sums))
            sums |= (sums << (length * take)) & within
            copies -= take
            power *= 2
    best = sums.bit_length() - 1
    found = Counter({longest: 1})
    for length, take, before in reversed(rows):
        if not before >> best & 1:
            found[length] += take
            best -= length * take
    return found


def fill(counts: dict[int, int], capacity: int) -> Iterator[tuple[int, Counter]]:
    """(number of sequences, their combination of lengths) until all counted pieces are placed."""
    counts = {length: n for length, n in counts.items() if n}
    while counts:
        kind = fullest(counts, capacity)
        times = min(counts[length] // n for length, n in kind.items())
        yield times, kind
        for length, n in kind.items():
            counts[length] -= times * n
            if not counts[length]:
                del counts[length]


def packing_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces a sequence, first sequence, offset), by length and rank.

    Of each length the pieces of ranks from ``first rank`` on go, so many a sequence, to
    consecutive sequences, beginning at ``offset`` in each.
    """
    rows, used, sequence = [], Counter(), 0
    for times, kind in fill(counts, capacity):
        offset = 0
        for length, n in sorted(kind.items(), reverse=True):
            rows.append((length, used[length], n, sequence, offset))
            used[length] += times * n
            offset += length * n
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _cutter(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = encoder(path), np.array([end_id], "<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), Counter()
        names = [c.split()[0] for c in PIECES.split(", ")]
        for batch in batches:
            rows, kept = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.encode(text.as_buffer().to_pybytes()) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    length = len(cut) // 4
                    rows.append((i, piece, at // 4, length, zlib.crc32(cut), task, seen[length]))
                    seen[length] += 1
                    if with_ids:
                        kept.append(cut)
            if rows:
                columns = [pa.array(c, pa.int32() if n == "piece" else pa.int64()) for c, n in zip(zip(*rows), names)]
                columns, more = (columns + [pa.array(kept, pa.binary())], ["ids"]) if with_ids else (columns, [])
                yield pa.RecordBatch.from_arrays(columns, names + more)

    return run


def _placer(plan: np.ndarray, schema: list[str]):
    # one number per row of the plan that grows with (length, rank)
    key = plan[:, 0] << 48 | plan[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(schema.index(c)).to_numpy() for c in ("length", "rank"))
            row = plan[np.searchsorted(key, length << 48 | rank, side="right") - 1]
            nth = rank - row[:, 1]
            columns = [batch.column(schema.index(c)) for c in schema if c != "rank"]
            columns += [pa.array(row[:, 3] + nth // row[:, 2]), pa.array(row[:, 4] + nth % row[:, 2] * length)]
            yield pa.RecordBatch.from_arrays(columns, [*(c for c in schema if c != "rank"), "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """Place every document's tokens in sequences of at most ``capacity`` tokens.

    A document is its text's ids and ``end_id``; only longer ones are cut, each
    ``capacity`` tokens. Columns, a row per piece: doc_id, piece (from 0), start (ids of
    the document before it), length, ids_crc32, sequence_id, offset (gapless from 0 in each
    sequence), and with ``with_ids`` the ids as little-endian 32-bit integers.

    NULL and empty texts are the end id alone; NULL ids and repeated rows are documents of
    their own; pieces of one length are interchangeable, so ties change nothing; an empty
    table gives no rows; further columns are ignored. A text is encoded in one task, its
    pieces are spread like any others.

    The driver holds the counts of the lengths and the plan: at most ``capacity`` kinds of
    at most sqrt(2 * capacity) lengths, 130,000 rows of five numbers for 2,048.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    pieces = stage(texts.mapInArrow(_cutter(tokenizer, capacity, end_id, with_ids), PIECES + (", ids binary" if with_ids else "")))
    # pieces of a length are numbered by task, then within it
    in_task = stage(pieces.groupBy("length", "task").agg(F.count("*").alias("n")))
    counts = {r.length: r.n for r in in_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = packing_plan(counts, capacity)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = in_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "task"]).withColumn("rank", F.col("before") + F.col("place"))
    columns = [c for c in pieces.columns if c not in ("task", "place")]
    kinds = dict(pieces.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns) + ", sequence_id long, offset long"
    return ranked.select(*columns, "rank").mapInArrow(_placer(plan, [*columns, "rank"]), schema)


def packed_sequences(pieces: DataFrame) -> DataFrame:
    """The sequences of ``pack``: sequence_id, n_tokens and all ids, as little-endian 32-bit integers."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
