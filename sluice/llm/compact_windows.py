"""Near-duplicate passages by compact windows over token min-hashes.

The tokens of a text are its word shingles. For one hash function, all stretches of a text
in which token c is the smallest and which lie within (l, r) share a min-hash: a compact
window (l, c, r). The windows that can hold PASSAGE words follow from a Cartesian tree over
the tokens that are smallest in some stretch of that length; there are about 2 n / PASSAGE
of them, instead of n^2 stretches. Two passages of Jaccard similarity s have the same
min-hash under a share s of the functions.

Windows are shuffled by min-hash. In each group they are tied to the window of the first
text, so a passage that very many texts have costs one row a text and function, never all
pairs. For each tied pair of texts an interval join finds the stretches that lie in windows
of enough functions at once; these candidates are verified on their tokens, and only
passages that reach the similarity are returned.

Texts that are equal are one text: their other copies are repeated as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import (
    SPACED,
    Words,
    blocks,
    byte_codes,
    folded,
    maybe_among,
    mix,
    powers,
    prefix_hashes,
    shingles,
    text_bytes,
    texts,
)
from sluice.operators.skew import mark_hot, split_lookup
from sluice.sources.staging import Staging

SHINGLE = 5  # words
PASSAGE = 50  # words
SIMILAR = 0.8
FUNCTIONS = 8
ENOUGH = 4  # functions that must agree before tokens are compared

CODES = folded(byte_codes(7))
REACH = (1 << 14) - 1  # tokens that a window is described by on either side of c


def least_windows(
    values: np.ndarray, bits: int, text: np.ndarray, edges: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) of the compact windows of at least `width` tokens in a block of texts.

    The low `bits` bits of a value are its place. `text` says which text a place is in,
    `edges` where texts begin, and the end.
    """
    none = np.zeros(0, np.int64)
    if len(values) < width:
        return none, none, none
    low, have = values, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    # The places of the values that are least in some stretch within one text: the place
    # changes where another value becomes the least one.
    place = (low[text[: len(low)] == text[width - 1 :]] & np.uint64((1 << bits) - 1)).astype(np.int64)
    if not len(place):
        return none, none, none
    centers = place[np.concatenate([[True], place[1:] != place[:-1]])]
    # Nearest smaller values on both sides are such places too: a Cartesian tree of them,
    # kept as the stack of its right edge.
    left, right = edges[text[centers]].tolist(), (edges[text[centers] + 1] - 1).tolist()
    stack: list[int] = []
    own, owner, at = values[centers].tolist(), text[centers].tolist(), centers.tolist()
    last = -1
    for i, value in enumerate(own):
        if owner[i] != last:
            stack, last = [], owner[i]
        while stack and own[stack[-1]] > value:
            right[stack.pop()] = at[i] - 1
        if stack:
            left[i] = at[stack[-1]] + 1
        stack.append(i)
    left, right = np.array(left, np.int64), np.array(right, np.int64)
    wide = right - left + 1 >= width
    return left[wide], centers[wide], right[wide]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return shingles(Words(data, offsets, SPACED, CODES), SHINGLE, whole_if_short=False)


def _windows(width: int, functions: int) -> Callable:
    """(key, doc_id, packed) of every text, and of equal texts of a task only the first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[str] = set()
        for batch in batches:
            fresh = []
            for i, digest in enumerate(batch.column("digest").to_pylist()):
                if digest not in done:
                    done.add(digest)
                    fresh.append(i)
            part = batch.take(pa.array(fresh, pa.int64()))
            ids = np.asarray(part.column("doc_id"))
            data, offsets = text_bytes(part.column("text"))
            for a, b in blocks(offsets):
                gram, first = tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                if not len(gram):
                    continue
                bits = max(22, len(gram).bit_length())
                place = np.arange(len(gram), dtype=np.uint64)
                high = np.uint64((1 << 64) - (1 << bits))
                text = np.repeat(np.arange(b - a), np.diff(first))
                for f in range(functions):
                    value = mix(gram + np.uint64(0x9E3779B97F4A7C15 * (f + 1) % (1 << 64)))
                    l, c, r = least_windows((value & high) | place, bits, text, first, width)
                    at = c - first[text[c]]
                    packed = (at << 32) | (np.minimum(c - l, REACH) << 18) | (np.minimum(r - c, REACH) << 4) | f
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mix(value[c] + np.uint64(f)).view(np.int64)), pa.array(ids[a + text[c]]), pa.array(packed)],
                        names=["key", "doc_id", "packed"],
                    )

    return run


# A packed window has 31 bits for the place of c, more than a text can have tokens. Cutting
# its sides at REACH loses nothing: every stretch it stands for lies within `width` of c.
def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r, f)."""
    c = packed >> 32
    return c - ((packed >> 18) & REACH), c, c + ((packed >> 4) & REACH), packed & 15


def _tie(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, other, packed, at): windows and the first text's window of their group.

    From rows sorted by (key, doc_id, packed). The first text's window, tied to itself,
    stands for it if it has company; (other, at, function) names the group.
    """
    hub = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, doc, packed = (np.asarray(batch.column(c)) for c in ("key", "doc_id", "packed"))
        if hub is not None:
            key, doc, packed = (np.concatenate([[h], x]) for h, x in zip(hub, (key, doc, packed)))
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        first = np.repeat(starts, np.diff(np.append(starts, len(key))))
        tied = np.flatnonzero(doc != doc[first])
        last = starts[-1]
        hub = (key[last], doc[last], packed[last])
        if tied.size:
            tied = np.concatenate([np.unique(first[tied]), tied])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[tied]), pa.array(doc[first[tied]]), pa.array(packed[tied]), pa.array((packed >> 32)[first[tied]].astype(np.int32))],
                names=["doc_id", "other", "packed", "at"],
            )


def stretches(packed: np.ndarray, at: np.ndarray, enough: int) -> list[tuple[int, int, int, int]]:
    """(from, to, other from, other to): tokens in windows of `enough` functions at once.

    An interval join by sweeping over the windows' ends; the other text's side follows
    from the distances between the tied centres.
    """
    l, c, r, f = unpack(packed)
    events = sorted([(int(x), 1, i) for i, x in enumerate(l)] + [(int(x) + 1, 0, i) for i, x in enumerate(r)])
    active: dict[int, set[int]] = {}
    out, inside, start, members = [], False, 0, set()
    for place, begins, i in events:
        if begins:
            active.setdefault(int(f[i]), set()).add(i)
            members.add(i)
        else:
            own = active[int(f[i])]
            own.discard(i)
            if not own:
                del active[int(f[i])]
        if not inside and len(active) >= enough:
            inside, start, members = True, place, set().union(*active.values())
        elif inside and len(active) < enough:
            inside = False
            shift = [int(c[m]) - int(at[m]) for m in members]
            out.append((start, place, start - max(shift), place - min(shift)))
    return out


def _lists(column: pa.Array, *names: str) -> Iterator[list[np.ndarray]]:
    """The fields of each row's list of structs; empty ones for a null."""
    sizes = np.diff(np.append(0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
    inner = column.flatten()
    fields = [inner.field(inner.type.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
    place = 0
    for size in sizes:
        yield [f[place : place + size] for f in fields]
        place += size


def _candidates(enough: int, width: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids = batch.column("doc_id").to_pylist()
            for doc, (others, packed, at) in zip(ids, _lists(batch.column("ties"), "other", "packed", "at")):
                order = np.argsort(others, kind="stable")
                edges = np.flatnonzero(np.diff(others[order])) + 1
                for mine in np.split(order, edges):
                    other = int(others[mine[0]])
                    if other == doc or len(np.unique(packed[mine] & 15)) < enough:
                        continue
                    for start, end, low, high in stretches(packed[mine], at[mine], enough):
                        # Whole multiples of the width, so that few different stretches are asked for.
                        rows.append((doc, other, *(x for s, e in ((start, end), (low, high)) for x in (
                            max(0, (s // width - 1) * width), (e // width + 2) * width))))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:2]), *(pa.array(c, pa.int32()) for c in columns[2:])],
                names=["doc_id", "other", "start", "end", "other_start", "other_end"],
            )

    return run


def runs(places: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the runs of consecutive sorted numbers."""
    return [(int(x[0]), int(x[-1]) + 1) for x in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1) if len(x)]


def unexplained(
    packed: np.ndarray, others: np.ndarray, done: list[tuple[int, int]],
    enough: int, width: int, functions: int, similar: float,
) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
    """(pairs of windows, ranges of starts by window) that the passages `done` leave open in one text.

    Pairs: windows of two functions, tied to different texts (one text has been compared
    already), that share a stretch of `width` tokens which has partners under `enough`
    functions, and of which less than `similar` lies in a found passage.
    Ranges: (window, from, to), starts of stretches with partners under all functions that lie in none.
    """
    l, c, r, f = unpack(packed)
    # A window stands for the stretches that contain c and begin from `low` to `high`.
    low, high = np.maximum(l, c - width + 1), np.minimum(c, r - width + 1)
    base = int(low.min())
    size = int(high.max()) - base + 1
    met, own = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
    for one in range(functions):
        own[:] = 0
        mine = f == one
        np.add.at(own, low[mine] - base, 1)
        np.add.at(own, high[mine] + 1 - base, -1)
        met += np.cumsum(own) > 0
    start = np.arange(base, base + size)
    covered = np.zeros(size, np.int64)
    for a, b in done:
        x, y = max(0, a - width - base), min(size, b - base)
        if x < y:
            part = np.minimum(start[x:y] + width, b) - np.maximum(start[x:y], a)
            covered[x:y] = np.maximum(covered[x:y], part)
    whole = start[(met[:size] >= functions) & (covered < width)]
    open_ = start[(met[:size] >= enough) & (covered < similar * width)]
    pairs: set[tuple[int, int]] = set()
    order = np.argsort(low, kind="stable")
    reach = np.maximum.accumulate(high[order])

    def holding(a: int, b: int) -> np.ndarray:
        """Windows that hold starts from a to b, by `low`; those of one function are disjoint."""
        near = order[np.searchsorted(reach, a) : np.searchsorted(low[order], b)]
        return near[high[near] >= a]

    for a, b in runs(open_):
        near = holding(a, b)
        for at, i in enumerate(near):
            for j in near[at + 1 :]:
                if low[j] > min(high[i], b - 1):
                    break
                if f[i] != f[j] and others[i] != others[j] and max(low[i], low[j], a) <= min(high[i], high[j]):
                    pairs.add((int(i), int(j)))
    ranges = [
        (int(i), max(a, int(low[i])), min(b, int(high[i]) + 1)) for a, b in runs(whole) for i in holding(a, b)
    ]
    return sorted(pairs), ranges


def _again(enough: int, width: int, functions: int, similar: float) -> Callable:
    """(key, doc_id, packed) of windows under two functions' groups; without key: starts of strings.

    Strings are asked of the text itself and of the first texts that its windows are tied to,
    which may have found another partner for theirs.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs, values, known = [], [], [], []
            ids = batch.column("doc_id").to_pylist()
            ties = _lists(batch.column("ties"), "other", "packed", "at")
            found = _lists(batch.column("done"), "start_word", "end_word")
            for doc, (others, packed, at), (a, b) in zip(ids, ties, found):
                packed, first = np.unique(packed, return_index=True)
                if len(np.unique(packed & 15)) < enough:
                    continue
                done = list(zip(a.tolist(), (b - SHINGLE + 1).tolist()))
                pairs, strings = unexplained(packed, others[first], done, enough, width, functions, similar)
                group = mix(others[first].astype(np.uint64) + mix((at[first].astype(np.uint64) << np.uint64(4)) | (packed & 15).astype(np.uint64)))
                if pairs:
                    both = np.array(pairs)
                    key = mix(group[both[:, 0]] + group[both[:, 1]])
                    for side in (0, 1):
                        own = packed[both[:, side]]
                        keys.append(mix(key + (own & 15).astype(np.uint64)).view(np.int64))
                        values.append(own)
                        docs.append(np.full(len(own), doc, np.int64))
                        known.append(np.ones(len(own), bool))
                if strings:
                    window, low, high = np.array(strings, np.int64).T
                    shift = at[first[window]].astype(np.int64) - (packed[window] >> 32)
                    asks = [np.stack((np.full(len(low), doc, np.int64), low, high), 1),
                            np.stack((others[first[window]], np.maximum(low + shift, 0), np.maximum(high + shift, 0)), 1)]
                    asks = np.unique(np.concatenate(asks), axis=0)
                    docs.append(asks[:, 0])
                    values.append((asks[:, 1] << 32) | asks[:, 2])
                    keys.append(np.zeros(len(asks), np.int64))
                    known.append(np.zeros(len(asks), bool))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys), mask=~np.concatenate(known)), pa.array(np.concatenate(docs)), pa.array(np.concatenate(values))],
                    names=["key", "doc_id", "packed"],
                )

    return run


def _strings(width: int) -> Callable:
    """(string, doc_id, start) of the strings of `width` tokens that are asked for, by 128-bit hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            asked, ids = batch.column("asked").to_pylist(), batch.column("doc_id").to_pylist()
            for a, b in blocks(offsets):
                gram, first = tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                sums = [prefix_hashes(gram), prefix_hashes(mix(gram + np.uint64(1)))]
                _, down = powers(len(gram) + 1)
                for i in range(a, b):
                    starts = np.unique(np.concatenate([np.arange(x >> 32, x & 0xFFFFFFFF) for x in asked[i]])) + first[i - a]
                    starts = starts[starts + width <= first[i - a + 1]]
                    halves = [mix((s[starts + width] - s[starts]) * down[starts]) for s in sums]
                    raw = pa.py_buffer(np.ascontiguousarray(np.stack(halves, 1)).tobytes())
                    string = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(starts), [None, raw]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [string, pa.array(np.full(len(starts), ids[i], np.int64)), pa.array((starts - first[i - a]).astype(np.int32))],
                        names=["string", "doc_id", "start"],
                    )

    return run


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of the stretches that are asked for, 32 bits each."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        asked, ids = batch.column("asked").to_pylist(), batch.column("doc_id").to_pylist()
        rows = []
        for a, b in blocks(offsets):
            gram, first = tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            small = (gram >> np.uint64(32)).astype(np.uint32)
            for i in range(a, b):
                own = small[first[i - a] : first[i - a + 1]]
                rows += [(ids[i], s["start"], s["end"], own[s["start"] : s["end"]].tobytes()) for s in asked[i]]
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "start", "end", "tokens"]
        )


def lengthened(
    one: np.ndarray, two: np.ndarray, found: tuple[int, int, int, int], width: int, similar: float
) -> list[tuple[int, int, int, int, float]]:
    """The best passage of `width` tokens or more on both sides around a shorter one; none if not similar."""
    low, high, a, b = found

    def wider(start: int, end: int, size: int) -> list[tuple[int, int]]:
        more = max(width - (end - start), 0)
        ends = [(start - k, end + more - k) for k in range(more + 1)]
        return [(x, y) for x, y in ends if x >= 0 and y <= size]

    best: list[tuple[int, int, int, int, float]] = []
    others = [(*w, np.unique(two[slice(*w)])) for w in wider(a, b, len(two))]
    for start, end in wider(low, high, len(one)):
        x = np.unique(one[start:end])
        for other_start, other_end, y in others:
            both = len(np.intersect1d(x, y, assume_unique=True))
            value = both / (len(x) + len(y) - both)
            if value >= similar and (not best or value > best[0][4]):
                best = [(start, end, other_start, other_end, value)]
    return best


def passages(one: np.ndarray, two: np.ndarray, width: int, similar: float) -> list[tuple[int, int, int, int, float]]:
    """(from, to, other from, other to, similarity) of the near-duplicate passages.

    Starts from all that both have in common and parts it at the widest gap until the
    similarity of the sets of tokens is reached, or too little is left.
    """
    order = np.argsort(two, kind="stable")
    found = np.searchsorted(two, one, sorter=order)
    found[found == len(two)] = 0
    where = order[found] if len(two) else found
    common = np.flatnonzero(two[where] == one) if len(two) else np.zeros(0, np.int64)
    waiting, out = [common], []
    while waiting:
        part = waiting.pop()
        if len(part) < width * similar:
            continue
        low, high = int(part[0]), int(part[-1]) + 1
        other = where[part]
        a, b = int(other.min()), int(other.max()) + 1
        x, y = np.unique(one[low:high]), np.unique(two[a:b])
        both = len(np.intersect1d(x, y, assume_unique=True))
        value = both / (len(x) + len(y) - both)
        if value >= similar:
            if min(high - low, b - a) >= width:
                out.append((low, high, a, b, value))
            else:
                out += lengthened(one, two, (low, high, a, b), width, similar)
            continue
        # The widest gap, in either text.
        gaps = np.maximum(np.diff(part), np.abs(np.diff(other)))
        cut = int(np.argmax(gaps)) + 1
        waiting += [part[:cut], part[cut:]]
    return out


def _verify(width: int, similar: float) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                one, two = (np.frombuffer(row[c], np.uint32) for c in ("tokens", "other_tokens"))
                for a, b, x, y, value in passages(one, two, width, similar):
                    ends = (row["start"] + a, row["start"] + b + SHINGLE - 1)
                    others = (row["other_start"] + x, row["other_start"] + y + SHINGLE - 1)
                    rows.append((row["doc_id"], *ends, row["other"], value))
                    rows.append((row["other"], *others, row["doc_id"], value))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "start_word", "end_word", "other", "similarity"],
            )

    return run


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of a text that overlap, as one."""
    for batch in batches:
        rows = []
        for doc, found in zip(batch.column("doc_id").to_pylist(), batch.column("found").to_pylist()):
            open_ = None
            for s in sorted(found, key=lambda s: (s["start_word"], s["end_word"])):
                if open_ and s["start_word"] < open_[2]:
                    open_ = (doc, open_[1], max(open_[2], s["end_word"]), min(open_[3], s["other"]), max(open_[4], s["similarity"]))
                else:
                    rows += [open_] if open_ else []
                    open_ = (doc, s["start_word"], s["end_word"], s["other"], s["similarity"])
            rows.append(open_)
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["doc_id", "start_word", "end_word", "first_doc", "similarity"],
        )


def _ties(windows: DataFrame, enough: int) -> DataFrame:
    """(doc_id, ties): each text's windows that others share, at most all it has.

    Texts that share them under fewer than `enough` functions can have no passage.
    """
    functions_met = F.expr("bit_count(bit_or(shiftleft(1, cast(packed & 15 AS int))))")
    return (
        windows.repartition("key")
        .sortWithinPartitions("key", "doc_id", "packed")
        .mapInArrow(_tie, "doc_id bigint, other bigint, packed bigint, at int")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("other", "packed", "at")).alias("ties"), functions_met.alias("_n"))
        .where(F.col("_n") >= enough)
        .drop("_n")
    )


def _asked_texts(known: DataFrame, asked: DataFrame) -> DataFrame:
    return (
        maybe_among(known, "doc_id", asked, "_doc")
        .join(asked.hint("merge"), F.col("doc_id") == F.col("_doc"))
        .select("doc_id", "text", "asked")
    )


def _spans(known: DataFrame, ties: DataFrame, width: int, similar: float, enough: int, staging: Staging) -> DataFrame:
    """(doc_id, start_word, end_word, other, similarity): verified passages of tied texts."""
    candidates = staging.pin(
        ties.mapInArrow(_candidates(enough, width), "doc_id bigint, other bigint, start int, end int, other_start int, other_end int"),
        "candidates",
    )
    sides = candidates.select("doc_id", "start", "end").unionAll(
        candidates.select(F.col("other"), F.col("other_start"), F.col("other_end"))
    )
    asked = (
        sides.distinct().groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list(F.struct("start", "end")).alias("asked"))
    )
    cuts = staging.pin(
        _asked_texts(known, asked).mapInArrow(_cut, "doc_id bigint, start int, end int, tokens binary").dropDuplicates(["doc_id", "start", "end"]),
        "stretches",
    )
    own = cuts.select(F.col("doc_id").alias("_a"), F.col("start").alias("_as"), F.col("end").alias("_ae"), "tokens")
    other = cuts.select(
        F.col("doc_id").alias("_b"), F.col("start").alias("_bs"), F.col("end").alias("_be"), F.col("tokens").alias("other_tokens")
    )
    met = candidates.join(
        own, (F.col("doc_id") == F.col("_a")) & (F.col("start") == F.col("_as")) & (F.col("end") == F.col("_ae"))
    ).join(other, (F.col("other") == F.col("_b")) & (F.col("other_start") == F.col("_bs")) & (F.col("other_end") == F.col("_be")))
    verified = met.select("doc_id", "start", "other", "other_start", "tokens", "other_tokens").mapInArrow(
        _verify(width, similar), "doc_id bigint, start_word int, end_word int, other bigint, similarity double"
    )
    return staging.pin(
        verified.groupBy("doc_id", "start_word", "end_word").agg(
            F.least(F.min("other"), F.col("doc_id")).alias("other"), F.max("similarity").alias("similarity")
        ),
        "spans",
    )


def repeated_passages(
    docs: DataFrame,
    passage: int = PASSAGE,
    similar: float = SIMILAR,
    functions: int = FUNCTIONS,
    enough: int = ENOUGH,
    staging: Staging | None = None,
) -> DataFrame:
    """Passages that occur, nearly alike, in other texts too.

    One row per passage of a document: doc_id, start_word, end_word (exclusive, words
    between ASCII white space), first_doc (the smallest doc_id it was found in, possibly
    its own), similarity (the best found). A passage has `passage` words at least, and the
    sets of 5-word shingles (A-Z lower-cased) of both sides have a Jaccard similarity of
    `similar` or more. Documents without any have no row. Copies of an equal text are
    repeated as a whole if they are long enough.

    Every exact passage that no found passage of its text covers already is found, whoever is
    first in its groups; not, if all its partners found others in the same place and none of
    them is first in a group of it. Near-duplicate ones are found if min-hashes agree, see ENOUGH; the tests
    measure the recall. Texts may have any length that Spark can hold.

    Null texts are empty and have none. Rows that repeat a doc_id with one text are copies
    of each other; rows without doc_id have no place in the result and are left out.
    Other columns are ignored, an empty table gives no rows.
    """
    staging = staging or Staging(docs.sparkSession)
    width = passage - SHINGLE + 1
    known = texts(docs).where(F.col("doc_id").isNotNull()).withColumn("digest", F.md5("text"))
    windows = known.mapInArrow(_windows(width, functions), "key bigint, doc_id bigint, packed bigint")
    ties = staging.pin(_ties(windows, enough), "ties")
    spans = _spans(known, ties, width, similar, enough, staging)

    # What these passages leave open: finer groups, and strings.
    done = spans.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list(F.struct("start_word", "end_word")).alias("done"))
    again = staging.pin(
        ties.join(done.hint("merge"), F.col("doc_id") == F.col("_doc"), "left").select("doc_id", "ties", "done")
        .mapInArrow(_again(enough, width, functions, similar), "key bigint, doc_id bigint, packed bigint"),
        "again",
    )
    finer = _spans(known, staging.pin(_ties(again.where("key IS NOT NULL"), enough), "ties"), width, similar, enough, staging)
    asked = again.where("key IS NULL").groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set("packed").alias("asked"))
    strings = staging.pin(
        _asked_texts(known, asked).mapInArrow(_strings(width), "string binary, doc_id bigint, start int"), "strings"
    )
    shared = (
        strings.groupBy("string")
        .agg(F.min("doc_id").alias("other"), F.max("doc_id").alias("_last"), F.count(F.lit(1)).alias("n_rows"))
        .where("other < _last")
    )
    shared = mark_hot(shared.drop("_last"), strings.count())
    exact = split_lookup(
        strings, "string", shared.where("hot"), shared.where("NOT hot"), ["other"], spread_by=["doc_id", "start"]
    ).where("_found")
    spans = spans.unionAll(finer).unionAll(
        exact.select("doc_id", F.col("start").alias("start_word"), (F.col("start") + passage).alias("end_word"), "other", F.lit(1.0).alias("similarity"))
    )
    found = spans.groupBy("doc_id").agg(
        F.collect_list(F.struct("start_word", "end_word", "other", "similarity")).alias("found")
    ).mapInArrow(_merge, "doc_id bigint, start_word bigint, end_word bigint, first_doc bigint, similarity double")

    # Texts with copies: the whole text is repeated, whatever parts of it were found.
    n_words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")).cast("bigint")
    listed = staging.pin(known.select("doc_id", "digest", n_words.alias("n_words")), "digests")
    groups = listed.groupBy("digest").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n_rows"))
    copies = groups.where("n_rows > 1")
    marked = mark_hot(copies, listed.count())
    member = split_lookup(
        listed, "digest", marked.where("hot"), marked.where("NOT hot"), ["first_doc"], spread_by=["doc_id"]
    ).where("_found")
    whole = member.where(F.col("n_words") >= passage).select(
        "doc_id", F.lit(0).cast("bigint").alias("start_word"), F.col("n_words").alias("end_word"), "first_doc", F.lit(1.0).alias("similarity")
    )
    single = found.join(member.select(F.col("doc_id").alias("_copy")).distinct(), F.col("doc_id") == F.col("_copy"), "left_anti")
    return single.unionAll(whole.distinct())
