"""Best-fit packing of documents into token sequences by bin completion.

Only the histogram of piece lengths goes to the driver: at most `size` entries, however many pieces there are.
There, bin completion works on lengths with multiplicities. Around the largest length left it goes through the
undominated fillings of the rest of a sequence, by rising waste; sums that the lengths left can't make are never
tried. It branches on the filling and on how often it is used, most first: as often as the counts allow, so the
first descent has no more levels than there are lengths. A branch is pruned where the waste so far passes what an
improvement on the incumbent allows. Incumbents are best-fit decreasing, from the beginning and from nodes on the way.
Fillings are made when they are asked for, none is left out: the search ends when the incumbent meets a lower bound, when
all is searched, or after `steps` lengths looked at, its one limit. `search` says which it was and how far the bound is.

The plan, a few rows for each length, is joined to the pieces by their rank among those of their length.

Null texts and texts without tokens are one piece of the end mark alone. Repeated rows are packed as often as
they occur. An empty table gives no pieces. Extra columns are left out.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import mapped, materialise
from .pretokens import encoder

SIZE = 2048
#: Lengths looked at by the search; some seconds of the driver.
STEPS = 1_000_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, size: int = SIZE, key: str = "doc_id", column: str = "text", end: int = 0) -> DataFrame:
    """Pieces of at most `size` tokens of every whole text and its end mark; of a longer one, the first may be shorter."""
    mark = end.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = (encode(text) if text else b"") + mark
                n = len(ids) // 4
                at, stop = 0, (n - 1) % size + 1
                while at < n:
                    rows.append((doc, len(rows), at, stop - at, zlib.crc32(memoryview(ids)[4 * at : 4 * stop]), at == 0))
                    at, stop = stop, stop + size
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            number, numbers = 0, []
            for first in columns[5]:
                number = 0 if first else number + 1
                numbers.append(number)
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(numbers, pa.int32()), *(pa.array(columns[k], pa.int64()) for k in (2, 3, 4))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return mapped(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(column).alias("text")), cut, PIECES)


def best_fit(counts: dict[int, int], size: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best-fit decreasing on lengths with counts: [(filling as ((length, times), ...), how often)]."""
    left = {k: n for k, n in counts.items() if n}
    lengths = sorted(left)
    out = []
    while lengths:
        room, filling, k = size, [], len(lengths)
        while k:
            x = lengths[k - 1]
            times = min(left[x], room // x)
            filling.append((x, times))
            room -= times * x
            k = min(k - 1, bisect_right(lengths, room))
        often = min(left[x] // t for x, t in filling)
        out.append((tuple(filling), often))
        for x, t in filling:
            left[x] -= t * often
            if not left[x]:
                lengths.remove(x)
    return out


Filling = tuple[tuple[int, int], ...]


def lower_bound(counts: dict[int, int], size: int) -> int:
    """Sequences that any packing needs.

    For each k: lengths over size - k are alone with regard to those of k or more, lengths over half of size are in
    sequences of their own, and of the rest only what doesn't fit beside the latter needs more.
    """
    number, total = [0] * (size + 2), [0] * (size + 2)  # of the lengths under each
    for x in range(size + 1):
        number[x + 1], total[x + 1] = number[x] + counts.get(x, 0), total[x] + x * counts.get(x, 0)
    half, best = size // 2 + 1, -(-total[-1] // size)
    for k in range(half):
        alone, own = number[-1] - number[size - k + 1], number[size - k + 1] - number[half]
        beside = size * own - (total[size - k + 1] - total[half])
        best = max(best, alone + own + max(0, -(-(total[half] - total[k] - beside) // size)))
    return best


def reachable(left: dict[int, int], lengths: list[int], size: int) -> list[int]:
    """For each length x up to size, the sums up to size that lengths of x or less make, as bits. Stays an upper bound as counts fall."""
    within, made, out, at = (1 << size + 1) - 1, 1, [], 0
    for x in range(size + 1):
        if at < len(lengths) and lengths[at] == x:
            at, times, by = at + 1, min(left[x], size // x), 1
            while times:
                by = min(by, times)
                made |= made << x * by & within
                times -= by
                by *= 2
        out.append(made)
    return out


def fillings(left: dict[int, int], lengths: list[int], size: int, sums: list[int] | None = None, step: Callable[[int], None] = lambda n: None) -> Iterator[tuple[int, Filling]]:
    """(waste, filling) around the largest of lengths, by rising waste and then by falling lengths, made one by one.

    A filling is dominated by one that holds, in place of one of its lengths, a greater one that still fits, or one
    more. So a length only goes in where the greater ones that are within the waste of it are used up, and those no
    longer than the waste all go in. sums: of `reachable`, from these counts or greater ones. step(n) is told of the
    work. While the next filling is made, left and lengths must be as at the beginning.
    """
    largest = lengths[-1]
    room = size - largest
    sums = sums or reachable(left, lengths, size)
    used: dict[int, int] = {}

    def at_hand(x: int) -> int:
        return left[x] - (x == largest)

    def used_up(k: int, beyond: int) -> bool:
        """Of the lengths from place k on that are no longer than that, none is left; those over the room don't count."""
        return all(used.get(y, 0) == at_hand(y) for y in lengths[k : bisect_right(lengths, min(beyond, room))])

    def exactly(k: int, need: int, waste: int, least: int) -> Iterator[Filling]:
        """Of lengths from place `least` on and under place k."""
        if not need:
            yield ()
            return
        k = min(k, bisect_right(lengths, need))
        while k > least and sums[lengths[k - 1]] >> need & 1:
            step(1)
            x = lengths[k - 1]
            if not waste or used_up(k, x + waste):
                under = sums[x - 1]
                for times in range(min(at_hand(x), need // x), 0, -1):
                    if under >> need - times * x & 1:
                        used[x] = times
                        for rest in exactly(k - 1, need - times * x, waste, least):
                            yield ((x, times), *rest)
                used[x] = 0
            k -= 1

    for waste in range(room + 1):
        least = bisect_right(lengths, min(waste, room))
        small = tuple((x, at_hand(x)) for x in reversed(lengths[:least]) if at_hand(x))
        need = room - waste - sum(x * n for x, n in small)
        if need < 0:
            return  # with more waste still more lengths would have to go in
        step(1 + len(small))
        used.update(small)
        for rest in exactly(len(lengths), need, waste, least) if sums[room] >> need & 1 else ():
            if not all(used_up(bisect_right(lengths, x), x + waste) for x, _ in small):
                continue
            rest += small
            more = rest[0][1] if rest and rest[0][0] == largest else 0
            yield waste, ((largest, 1 + more), *(rest[1:] if more else rest))


@dataclass
class Search:
    """A packing, the least number of sequences that any has, the steps taken, and whether it is proven the best."""

    plan: list[tuple[Filling, int]]
    least: int
    steps: int
    proven: bool

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.plan)


@dataclass
class _Level:
    largest: int
    options: Iterator[tuple[int, Filling]]
    sums: list[int]
    age: int
    filling: Filling = ()
    waste: int = 0
    times: int = 0
    tried: int = 0


#: Choices tried at each level in a pass, and the share of the steps at which a pass ends. A mistake near the top is
#: mended by a narrow pass; the last one leaves nothing out.
PASSES = [(3, 0.3), (12, 0.6), (None, 1.0)]


def search(counts: dict[int, int], size: int = SIZE, steps: int = STEPS) -> Search:
    """Bin completion branch-and-bound over a histogram of lengths."""
    counts = {k: n for k, n in counts.items() if n}
    state = Search(best_fit(counts, size), lower_bound(counts, size), 0, False)
    for width, share in PASSES:
        whole = _pass(counts, size, state, width, int(share * steps))
        state.proven = whole or state.sequences <= state.least
        if state.proven:
            break
    return state


def _pass(counts: dict[int, int], size: int, state: Search, width: int | None, until: int) -> bool:
    """Look for better packings than the state has; whether nothing is left to try."""
    total = sum(k * n for k, n in counts.items())
    left, lengths = dict(counts), sorted(counts)
    levels: list[_Level] = []  # a stack of our own: there are as many levels as lengths
    bins, used, waste, since, whole = state.sequences, 0, 0, 0, True

    def step(n: int) -> None:
        state.steps += n
        if state.steps > until:
            raise _Enough

    def take(filling: Filling, times: int) -> None:
        for x, t in filling:
            had = left[x]
            left[x] -= t * times
            if not left[x]:
                del lengths[bisect_left(lengths, x)]
            elif not had:  # given back
                lengths.insert(bisect_left(lengths, x), x)

    def spare() -> int:
        """Waste that a packing with one sequence less than the incumbent has."""
        return (bins - 1) * size - total

    def go_down(after: _Level | None = None) -> None:
        """A level below, or a packing that is complete. Below the same largest length, only fillings that come later."""
        nonlocal bins, since
        since += 1
        if since >= 64 or len(lengths) <= 64:
            since = 0
            step(len(lengths))
            rest = best_fit({x: left[x] for x in lengths}, size)
            if (now := used + sum(n for _, n in rest)) < bins:
                state.plan, bins = [*((x.filling, x.times) for x in levels), *rest], now
        if lengths:
            sums, age = (after.sums, after.age + 1) if after and after.age < 32 else (reachable(left, lengths, size), 0)
            options = fillings(left, lengths, size, sums, step)
            if after and after.largest == lengths[-1]:
                last = _order(after.waste, after.filling)
                options = (x for x in options if _order(*x) > last)
            levels.append(_Level(lengths[-1], options, sums, age))

    try:
        go_down()
        while levels and bins > state.least:
            level = levels[-1]
            if level.times:  # once less often, or the next filling
                take(level.filling, -1)
                used, waste = used - 1, waste - level.waste
                level.times -= 1
            if level.tried == width:
                whole = False
                if level.times:
                    take(level.filling, -level.times)
                    used, waste = used - level.times, waste - level.waste * level.times
                levels.pop()
                continue
            level.tried += 1
            step(1)
            if not level.times:
                lost, filling = next(level.options, (spare() + 1, ()))
                if waste + lost > spare():  # the fillings after this one waste more
                    levels.pop()
                    continue
                level.filling, level.waste = filling, lost
                level.times = min(left[x] // t for x, t in filling)
                if lost:
                    level.times = min(level.times, (spare() - waste) // lost)
                take(filling, level.times)
                used, waste = used + level.times, waste + lost * level.times
            go_down(level)
    except _Enough:
        return False
    return whole and not levels


class _Enough(Exception):
    """The steps are used up."""


def _order(waste: int, filling: Filling) -> tuple:
    return waste, tuple((-x, -t) for x, t in filling)


def completion(counts: dict[int, int], size: int = SIZE, steps: int = STEPS) -> list[tuple[Filling, int]]:
    """Fillings and how often each is used."""
    return search(counts, size, steps).plan


def plan_rows(plan: list[tuple[tuple[tuple[int, int], ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, times in each, offset) for each length of each filling."""
    rows, sequence, rank = [], 0, {}
    for filling, often in plan:
        offset = 0
        for length, times in filling:
            first = rank.get(length, 0)
            rows.append((length, first, often * times, sequence, times, offset))
            rank[length] = first + often * times
            offset += length * times
        sequence += often
    return rows


def pack(docs: DataFrame, path: str, size: int = SIZE, key: str = "doc_id", column: str = "text", steps: int = STEPS) -> DataFrame:
    """Pieces of `docs` with sequence_id and offset."""
    return place(materialise(token_pieces(docs, path, size, key, column), "pieces"), size, steps)


#: Ranks among equal lengths are taken in groups of so many pieces at most, and of no more than this share of all.
GROUP, SHARE = 500_000, 1 / 256


def place(pieces: DataFrame, size: int = SIZE, steps: int = STEPS) -> DataFrame:
    """sequence_id and offset for pieces (doc_id, piece, length, ...), which must not change when read again.

    Ranks among equal lengths come from counts by (length, salt) and a window over each such group. A length has as
    many salts as its count needs for groups of GROUP pieces, or of a SHARE of all of them; so a length that most pieces
    have is dealt out, and what is broadcast is a row for each length and one more for each GROUP pieces.
    """
    spark = pieces.sparkSession
    by_length = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    most = max(1, min(GROUP, int(SHARE * sum(by_length.values()))))
    salts = spark.createDataFrame([(x, -(-n // most)) for x, n in by_length.items()], "s_length long, s_salts int")
    salted = pieces.join(F.broadcast(salts), F.col("length") == F.col("s_length"))
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("s_salts")).cast("int")).drop("s_length", "s_salts")
    total: dict[int, int] = {}
    before = []
    for r in salted.groupBy("length", "salt").count().orderBy("length", "salt").collect():
        before.append((r.length, r.salt, total.get(r.length, 0)))
        total[r.length] = total.get(r.length, 0) + r["count"]
    rows = plan_rows(completion(by_length, size, steps))
    # a length's ranks are cut into as many blocks as it has rows of the plan; so there are at most twice as many (row,
    # block) as rows, and a rank is looked for among two of them on average
    rows_of = Counter(r[0] for r in rows)
    width = {x: -(-by_length[x] // n) for x, n in rows_of.items()}
    blocks = [(block, *r) for r in rows for block in range(r[1] // width[r[0]], (r[1] + r[2] - 1) // width[r[0]] + 1)]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("p_block", "p_length", "p_rank", "p_ranks", "p_sequence", "p_times", "p_offset")])
    plan = spark.createDataFrame(blocks, schema)
    firsts = spark.createDataFrame([(x, salt, rank, width[x]) for x, salt, rank in before], "f_length long, f_salt int, f_rank long, f_width long")
    over = "row_number() over (partition by length, salt order by doc_id, start, ids_crc32) - 1"
    ranked = salted.withColumn("within", F.expr(over)).join(F.broadcast(firsts), (F.col("length") == F.col("f_length")) & (F.col("salt") == F.col("f_salt")))
    ranked = ranked.withColumn("rank", F.col("f_rank") + F.col("within")).withColumn("block", F.expr("rank div f_width"))
    own_row = (F.col("length") == F.col("p_length")) & (F.col("block") == F.col("p_block")) & (F.col("rank") >= F.col("p_rank")) & (F.col("rank") < F.col("p_rank") + F.col("p_ranks"))
    return (
        ranked.join(F.broadcast(plan), own_row)
        .select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            F.expr("p_sequence + (rank - p_rank) div p_times").alias("sequence_id"),
            F.expr("p_offset + ((rank - p_rank) % p_times) * length").alias("offset"),
        )
    )
