"""Packing token sequences by histogram.

Lengths of what is left of each document after whole windows are counted into bins. All shallow
combinations of bins that fill a window are columns of a non-negative least-squares problem whose
right side is that histogram; the rounded solution says how often each combination is used. What it
leaves is packed greedily, longest first, by its exact lengths; lengths for which nothing fits well
are cut at powers of two, and those pieces fill windows without a gap. The plan depends on the
histogram alone, at most one row per length, so its size has a bound that no table changes. Which
document takes which place follows from its rank among pieces of its length.

Documents with an order to keep are packed in segments of it, each by a plan of its own. Inside a
segment the windows are dealt evenly over the order, for every length alike, so the members of a
window stand near one another in it, and sequences are numbered by their first member.
"""

from __future__ import annotations

import math
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerometer.llm.common import blocks_for, text_of, written

WINDOW, END = 2048, 1
#: Lengths of one bin; a combination wastes less than this for each member.
BIN = 8
#: Bins of a combination at most.
DEPTH = 3
#: Padding up to which the greedy step takes a window.
SLACK = 24
#: Members of a greedy window at most.
MOST = 12
#: Rows that one task ranks at a time, about.
RANKED = 50_000
GOLDEN = (math.sqrt(5) - 1) / 2
#: Documents of a segment, about, where an order is kept; one slot of the order is never divided.
SEGMENT = 2_048
#: Rows that one task adds up in order at most.
CHUNK = 4_096
#: Words a worker remembers; then it forgets all and starts again.
REMEMBERED = 300_000

PIECES = ("doc_id long, tokens long, whole array<long>, rest long, rest_crc long, cut_crcs array<long>")
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, others for letters from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Little-endian ids of a text. Words between ASCII blanks are encoded once and remembered: the
    vocabulary's pre-tokenizer never joins across a blank, and its lower case covers A-Z.

    A word of Latin-1 letters alone is one pre-token that normalization only lower-cases, so it goes
    to the merges directly; any other word goes through the whole tokenizer. Two generations are
    kept: words met again move to the younger one, and the older is dropped when that is full.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.letters = byte_letters()

    def _merge(self, word: str, data: bytes) -> bytes:
        spelled = word if len(word) == len(data) else "".join(map(self.letters.__getitem__, data))
        return array("I", [t.id for t in self.model.model.tokenize(spelled)]).tobytes()

    def _encode(self, words: list[bytes]) -> None:
        merge, other = self._merge, []
        for data in words:
            word = data.decode("utf-8", "replace")
            if word.isalpha() and max(word) <= "\xff":
                low = word.lower()
                self.known[data] = merge(low, low.encode())
            else:
                other.append((data, word))
        if other:
            found = self.model.encode_batch_fast([w for _, w in other], add_special_tokens=False)
            self.known.update((d, array("I", e.ids).tobytes()) for (d, _), e in zip(other, found))

    def learn(self, words: set[bytes]) -> None:
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new, stems = [], {}
        for w in words:
            if w in older:
                known[w] = older[w]
            elif w[-1:] in b".," and w[-2:-1].isalnum():
                # a closing full stop or comma after an ASCII letter or digit is a token of its own
                stems[w] = w[:-1]
            elif w not in known:
                new.append(w)
        need = {x for x in (*stems.values(), b".", b",") if x not in known}
        known.update((x, older[x]) for x in need if x in older)
        self._encode([*new, *(x for x in need.difference(new) if x not in known)])
        known.update((w, known[s] + known[w[-1:]]) for w, s in stems.items())

    def ids(self, text: str) -> bytes:
        data = text.encode("utf-8", "replace")
        # the spelling of a special token decides whether it is one
        words = (data if b"<|" in data else data.lower()).split()
        distinct, known = set(words), self.known
        missing = {w for w in distinct if w not in known}
        if missing:
            self.learn(missing)
            if self.known is not known:
                self.learn({w for w in distinct if w not in self.known})
        return b"".join(map(self.known.__getitem__, words))


_ENCODERS: dict[str, Encoder] = {}


def powers(length: int) -> list[int]:
    """The powers of two that add up to a length, largest first."""
    return [1 << b for b in reversed(range(length.bit_length())) if length >> b & 1]


def encoder_of(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(ids: bytes, window: int) -> tuple[int, list[int], int, int, list[int]]:
    """Tokens, checksums of whole windows, length and checksum of the rest, checksums of its powers of two."""
    n, view = len(ids) // 4, memoryview(ids)
    whole = [zlib.crc32(view[4 * i:4 * (i + window)]) for i in range(0, n - window + 1, window)]
    rest, at, parts = n % window, n - n % window, []
    for size in powers(rest):
        parts.append(zlib.crc32(view[4 * at:4 * (at + size)]))
        at += size
    return n, whole, rest, zlib.crc32(view[4 * (n - rest):]), parts


def tokenized(docs: DataFrame, vocabulary: str, window: int = WINDOW, order: tuple[str, str] | None = None) -> DataFrame:
    """A row of PIECES for every document, with slot and place where an order (names of two columns) is given."""
    kept = ["slot", "place"] if order else []
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(vocabulary)
        for pdf in batches:
            rows = [cut(encoder.ids(t) + end, window) for t in pdf.text]
            out = pd.DataFrame(rows, columns=["tokens", "whole", "rest", "rest_crc", "cut_crcs"])
            out.insert(0, "doc_id", pdf.doc_id.to_numpy())
            for name in kept:
                out[name] = pdf[name].to_numpy()
            yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
                       *[F.col(f"`{c}`").cast("long").alias(name) for c, name in zip(order or (), kept)])
    return rows.mapInPandas(run, PIECES + "".join(f", {name} long" for name in kept))


def nnls(columns: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[int, float]:
    """Non-negative x that brings the weighted sum of columns nearest to target (active sets).

    columns holds for each column the rows it counts in, -1 for none. At most one column per row
    comes out positive.
    """
    rows = len(target)
    weight = np.append(weight, 0.0)
    goal = np.append(target, 0.0) * weight
    active: list[int] = []
    chosen, x = np.zeros((rows + 1, 0)), np.zeros(0)
    barred: set[int] = set()
    for _ in range(3 * rows):
        gain = ((goal - chosen @ x) * weight)[columns].sum(axis=1)
        gain[[*active, *barred]] = -np.inf
        best = int(np.argmax(gain)) if len(gain) else -1
        if best < 0 or gain[best] <= 1e-9 * max(1.0, float(goal.max(initial=0.0))):
            break
        new = np.zeros((rows + 1, 1))
        np.add.at(new, (columns[best], 0), weight[columns[best]])
        active, chosen, x = [*active, best], np.hstack([chosen, new]), np.append(x, 0.0)
        while active:
            normal = chosen.T @ chosen
            fit = np.linalg.solve(normal + 1e-10 * np.eye(len(active)), chosen.T @ goal)
            if fit.min() > 0:
                x = fit
                barred.clear()
                break
            falls = fit <= 0
            step = np.min(x[falls] / np.maximum(x[falls] - fit[falls], 1e-300))
            x = x + step * (fit - x)
            stays = x > 1e-9
            if stays.all():
                stays[np.argmin(x)] = False
            if best in [a for a, s in zip(active, stays) if not s]:
                barred.add(best)
            active, chosen, x = [a for a, s in zip(active, stays) if s], chosen[:, stays], x[stays]
    return dict(zip(active, x))


@lru_cache(maxsize=4)
def shallow(bins: int, depth: int = DEPTH) -> np.ndarray:
    """All combinations of two to depth bins (1..bins) whose sizes add up to bins, as rows of bin numbers - 1."""
    found = []
    for d in range(2, depth + 1):
        for head in combinations_with_replacement(range(1, bins), d - 1):
            last = bins - sum(head)
            if last >= head[-1]:
                found.append([b - 1 for b in (*head, last)] + [-1] * (depth - d))
    return np.array(found, dtype=np.int64).reshape(-1, depth)


def plan(histogram: dict[int, int], window: int = WINDOW) -> tuple[list[tuple], int]:
    """Places for all pieces of a histogram (length below window -> count), and the windows used.

    A place is (length, first rank, last rank, window of the first rank, slot): ranks of a length are
    dealt out in order, one window each. Slot -1 marks ranks that are cut at powers of two; for them
    the window holds the first rank's place in the order of cut pieces, see `power_bases`.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(left, 0)
    places: list[tuple] = []
    windows = 0

    def take(length: int, count: int, first: int, slot: int) -> None:
        if places and slot >= 0 and places[-1][0] == length and places[-1][4] == slot and places[-1][2] + 1 == used[length] \
                and places[-1][3] + places[-1][2] - places[-1][1] + 1 == first:
            old = places.pop()
            places.append((length, old[1], used[length] + count - 1, old[3], slot))
        else:
            places.append((length, used[length], used[length] + count - 1, first, slot))
        used[length] += count
        left[length] -= count

    bins = window // BIN
    counts = np.zeros(bins)
    for n, c in left.items():
        counts[(n - 1) // BIN] += c
    if left:
        columns = shallow(bins)
        solved = nnls(columns, counts, np.linspace(0.5, 1.0, bins))
        room = counts.astype(np.int64)
        for j, x in sorted(solved.items(), key=lambda s: (-s[1], s[0])):
            members = [b for b in columns[j] if b >= 0]
            times = int(round(x))
            for b in set(members):
                times = min(times, int(room[b]) // members.count(b))
            if times <= 0:
                continue
            for slot, b in enumerate(members):
                need, at = times, windows
                for n in range(min((b + 1) * BIN, window - 1), b * BIN, -1):
                    some = min(need, left.get(n, 0))
                    if some:
                        take(n, some, at, slot)
                        need, at = need - some, at + some
                room[b] -= times
            windows += times
    spare = np.zeros(window, np.int64)
    for n, c in left.items():
        spare[n] = c
    for n in sorted(left, reverse=True):
        while left[n]:
            space, members, have = window - n, [n], spare.copy()
            have[n] -= 1
            while space and len(members) < MOST:
                fits = np.flatnonzero(have[:space + 1])
                if not len(fits):
                    break
                members.append(int(fits[-1]))
                have[members[-1]] -= 1
                space -= members[-1]
            if space > SLACK:
                spare[n] = 0
                take(n, left[n], 0, -1)
                break
            times = min(left[m] // members.count(m) for m in set(members))
            for slot, m in enumerate(members):
                take(m, times, windows, slot)
                spare[m] -= times
            windows += times
    return places, windows


def power_bases(places: list[tuple], window: int = WINDOW) -> tuple[list[tuple], int]:
    """(length, first rank, last rank, place of the first cut piece) by its nth power, and their tokens.

    Cut pieces lie end to end by falling size, so each starts at a multiple of its size and none
    crosses a window's end.
    """
    cut_places = [p for p in places if p[4] == -1]
    total: dict[int, int] = {}
    for n, lo, hi, _, _ in cut_places:
        for size in powers(n):
            total[size] = total.get(size, 0) + hi - lo + 1
    start, at = {}, 0
    for size in sorted(total, reverse=True):
        start[size], at = at, at + size * total[size]
    out = []
    for n, lo, hi, _, _ in cut_places:
        for k, size in enumerate(powers(n)):
            out.append((n, lo, hi, k, size, start[size]))
            start[size] += size * (hi - lo + 1)
    return out, at


def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """pieces (length, piece_id, ...) with rank, from 0, among those of their length.

    A length may hold any share of all pieces: each is ranked in salted parts, and the parts' counts
    are added up before.
    """
    parts = blocks_for(total, RANKED)
    salted = pieces.withColumn("part", F.pmod(F.xxhash64("piece_id"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = salted.groupBy("length", "part").agg(F.count("*").alias("n")).select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "part").orderBy("piece_id")
    return (salted.withColumn("nth", F.row_number().over(inside)).join(sums, ["length", "part"])
            .withColumn("rank", F.col("base") + F.col("nth") - 1).drop("part", "base", "nth"))


def sums_before(rows: DataFrame, key: str, amount: str, out: str) -> DataFrame:
    """rows (key, amount; keys are different whole numbers) with out, the sum of the amounts of all smaller keys.

    Keys are cut into chunks of CHUNK, whose totals are added up in the same way, so a task orders
    CHUNK rows at most, however many there are.
    """
    ends = rows.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    return _sums_before(rows, key, amount, out, ends.lo or 0, (ends.hi or 0) - (ends.lo or 0))


def _sums_before(rows: DataFrame, key: str, amount: str, out: str, lo: int, width: int) -> DataFrame:
    chunk, total, base = (f"_{x}_{width}" for x in ("chunk", "total", "base"))
    cut = rows.withColumn(chunk, F.floor((F.col(key) - lo) / CHUNK).cast("long"))
    inside = Window.partitionBy(chunk).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn(out, F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    if width >= CHUNK:
        chunks = cut.groupBy(chunk).agg(F.sum(amount).alias(total))
        cut = cut.join(_sums_before(chunks, chunk, total, base, 0, width // CHUNK), chunk).withColumn(out, F.col(out) + F.col(base))
    return cut.select(*rows.columns, out)


def in_segments(rows: DataFrame) -> DataFrame:
    """rows with segment: ranges of slots of about SEGMENT rows each, numbered from 0 as the slots are.

    A slot is not cut, so a range can hold up to one slot's rows more. A null slot counts as -1.
    """
    rows = rows.withColumn("slot", F.coalesce(F.col("slot").cast("long"), F.lit(-1).cast("long")))
    counts = written(rows.groupBy("slot").agg(F.count("*").alias("n")), "pack-slots")
    ranges = sums_before(counts, "slot", "n", "ahead").select("slot", F.floor(F.col("ahead") / SEGMENT).cast("long").alias("segment"))
    return rows.join(ranges, "slot").select(*rows.columns, "segment")


def dealt(lengths: np.ndarray, places: list[tuple], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and slot of every piece (length 0: none, slot -2), pieces given in their order.

    Multiples of the golden section spread any run of windows evenly over the unit interval; the nth
    piece of a length takes the nth of its places in that spread. In windows with room for the
    largest lengths of their members' bins the pieces of a bin may change places, so they are dealt
    by bin there.
    """
    window, slot = np.zeros(len(lengths), np.int64), np.full(len(lengths), -2, np.int64)
    by_length = np.argsort(lengths, kind="stable")
    first = np.searchsorted(lengths[by_length], np.arange(int(lengths.max(initial=0)) + 2))
    runs: dict[int, list[tuple]] = {}
    for p in places:
        runs.setdefault(p[0], []).append(p)
    for n, ps in runs.items():
        at = np.concatenate([first_at + np.arange(hi - lo + 1) for _, lo, hi, first_at, _ in ps])
        of = np.concatenate([np.full(hi - lo + 1, s) for _, lo, hi, _, s in ps])
        spread = np.argsort(at * GOLDEN % 1, kind="stable")
        pieces = by_length[first[n]:first[n + 1]]
        window[pieces], slot[pieces] = at[spread], of[spread]
    put, bins = np.flatnonzero(slot >= 0), (lengths + BIN - 1) // BIN
    if len(put):
        room = np.bincount(window[put], weights=bins[put] * BIN)
        put = put[room[window[put]] <= size]
        # the same places twice: by bin and order of the pieces, and by bin and spread
        to = put[np.lexsort((window[put] * GOLDEN % 1, bins[put]))]
        put = put[np.argsort(bins[put], kind="stable")]
        window[put], slot[put] = window[to], slot[to]
    return window, slot


def pack_segment(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """The pieces of one segment's documents, sequences numbered from 0 by their first member's order."""
    rows = rows.sort_values(["slot", "place", "piece_id"], kind="stable", ignore_index=True)
    rest, tokens = rows.rest.to_numpy(), rows.tokens.to_numpy()
    counted = {int(n): int(c) for n, c in zip(*np.unique(rest[rest > 0], return_counts=True))}
    places, mixed = plan(counted, window)
    at, slot = dealt(rest, places, window)
    # pieces as (document's place in the order, start, length, checksum, sequence, offset)
    n_whole = rows.whole.map(len).to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(rows)), n_whole)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_whole) - n_whole, n_whole)
    crc = np.concatenate([np.asarray(w, np.int64) for w in rows.whole]) if len(doc) else np.zeros(0, np.int64)
    parts = []
    put = np.flatnonzero(slot >= 0)
    put = put[np.lexsort((slot[put], at[put]))]
    size, ends = rest[put], np.cumsum(rest[put])
    opens = np.searchsorted(at[put], at[put])
    parts.append((put, tokens[put] - size, size, rows.rest_crc.to_numpy()[put], at[put], ends - size - (ends - size)[opens]))
    cut_rows, base = np.flatnonzero(slot == -1), 0
    for power in powers(window - 1):
        held = cut_rows[(rest[cut_rows] & power) > 0]
        if not len(held):
            continue
        ahead = rest[held] - rest[held] % (2 * power)
        k = [int(x).bit_count() for x in ahead]
        start = base + power * np.arange(len(held))
        parts.append((held, tokens[held] - rest[held] + ahead, np.full(len(held), power),
                      np.array([c[i] for c, i in zip(rows.cut_crcs.to_numpy()[held], k)], np.int64), mixed + start // window, start % window))
        base += power * len(held)
    total = mixed + -(-base // window)
    parts.append((doc, nth * window, np.full(len(doc), window), crc, total + np.arange(len(doc)), np.zeros(len(doc), np.int64)))
    of, start, length, crcs, sequence, offset = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
    least = np.full(total + len(doc), len(rows), np.int64)
    np.minimum.at(least, sequence, of)
    number = np.empty(len(least), np.int64)
    number[np.argsort(least, kind="stable")] = np.arange(len(least))
    return pd.DataFrame({"segment": rows.segment.to_numpy()[of], "doc_id": rows.doc_id.array[of], "start": start, "length": length,
                         "ids_crc32": crcs, "doc_tokens": tokens[of], "sequence_id": number[sequence], "offset": offset})


def pack_in_order(rows: DataFrame, window: int) -> DataFrame:
    """What pack gives, from a stored table of tokenized rows with slot, place and piece_id."""
    found = written(in_segments(rows).groupBy("segment").applyInPandas(
        lambda pdf: pack_segment(pdf, window), f"segment long, {PACKED}"), "packed")
    used = written(found.groupBy("segment").agg((F.max("sequence_id") + 1).alias("n")), "pack-used")
    first = sums_before(used, "segment", "n", "base").select("segment", "base")
    return found.join(first, "segment").withColumn("sequence_id", F.col("sequence_id") + F.col("base")).drop("segment", "base")


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, order: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document (null text: empty) is its ids and the end id, so none is empty; repeated rows and
    rows of one doc_id are documents of their own. Whole windows come first, then what the plan deals
    out. Sequences are numbered from 0 without gaps; an empty table gives no rows.

    order: two whole-number columns, as mixing.mix adds them; sequences then follow it. A sequence
    holds documents of one segment (about SEGMENT in a row) and is numbered by the first of them.
    """
    spark = docs.sparkSession
    if window & (window - 1) or window % BIN:
        raise ValueError("window has to be a power of two and a multiple of the bin")
    rows = written(tokenized(docs, vocabulary, window, order).withColumn("piece_id", F.monotonically_increasing_id()), "tokens")
    if order:
        return pack_in_order(rows, window)
    counted = {r.rest: r.n for r in rows.where("rest > 0").groupBy("rest").agg(F.count("*").alias("n")).collect()}
    places, mixed = plan(counted, window)
    cuts, cut_tokens = power_bases(places, window)
    base_full = mixed + -(-cut_tokens // window)
    n_full = rows.agg(F.coalesce(F.sum(F.size("whole")), F.lit(0))).first()[0]

    whole = rows.select("doc_id", "tokens", "piece_id", F.posexplode("whole").alias("i", "crc")).select(
        F.lit(window).cast("long").alias("length"), F.xxhash64("piece_id", "i").alias("piece_id"), "doc_id",
        (F.col("i") * window).cast("long").alias("start"), F.col("crc").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"))
    whole = ranked(whole, n_full).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("rank") + base_full).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    rests = rows.where("rest > 0").select(
        F.col("rest").alias("length"), "piece_id", "doc_id", (F.col("tokens") - F.col("rest")).alias("start"),
        "rest_crc", "cut_crcs", F.col("tokens").alias("doc_tokens"))
    rests = ranked(rests, sum(counted.values()))
    table = lambda data, kind: F.broadcast(spark.createDataFrame(data, kind))  # noqa: E731  bounded by the window alone
    at = (F.col("length") == F.col("n")) & F.col("rank").between(F.col("lo"), F.col("hi"))
    put = rests.join(table([p for p in places if p[4] >= 0], "n long, lo long, hi long, first long, slot int"), at)
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    put = put.withColumn("sequence_id", F.col("first") + F.col("rank") - F.col("lo")).select(
        "doc_id", "start", "length", F.col("rest_crc").alias("ids_crc32"), "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))

    parts = rests.join(table(cuts, "n long, lo long, hi long, k int, size long, base long"), at)
    place = F.col("base") + F.col("size") * (F.col("rank") - F.col("lo"))
    # the powers of a length fall, so those before the kth are its bits above
    ahead = F.col("length") - F.pmod(F.col("length"), F.col("size") * 2)
    parts = parts.select(
        "doc_id", (F.col("start") + ahead).alias("start"), F.col("size").alias("length"),
        F.get("cut_crcs", F.col("k")).alias("ids_crc32"), "doc_tokens",
        (F.lit(mixed) + F.floor(place / window)).cast("long").alias("sequence_id"),
        F.pmod(place, F.lit(window)).cast("long").alias("offset"))
    return whole.unionByName(put).unionByName(parts)
