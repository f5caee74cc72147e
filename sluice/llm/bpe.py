"""Byte-pair encoding as a bounded-lookahead transducer, and incremental decoding.

The merge list alone decides the tokens. Instead of applying merges over and over, the
encoder reads a stretch of bytes once from the left and keeps, for every position, the
last token of the encoding of the bytes before it. A token can follow another exactly if
no merge across their border would have come first (`Merges.stays`). Since a merge never
crosses a border that the final encoding has, these last tokens chain back to the whole
encoding.

Short stretches are read side by side, one column of bytes after the other, with lookups of
all of them at once; a long one is read by itself.

What was read may still be regrouped by bytes to come, but only over a bounded distance:
a change can move left only through merges of ever higher rank whose right part is the
left part of the one before. `Merges.lookahead` follows these chains through the merge
list. Tokens that end further back are stable and are emitted, so a stretch of any length
needs constant memory.
"""

from __future__ import annotations

import hashlib
import json
import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from sluice.llm.common import byte_codes, texts

# Fixed values of byte-level BPE: its splitting pattern, written with Unicode's
# White_Space property, and the printable stand-ins of the bytes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

CACHED_CHARS = 64  # longer pieces are encoded anew each time
CACHED_PIECES = 300_000  # then the cache starts over: bounded memory
FLUSH_EVERY = 256
SIDE_BY_SIDE = 32  # bytes; longer stretches are read by themselves
BLOCK_CHARS = 4 << 20  # of texts that are encoded together
MOST_PAIRS = 1 << 21


def byte_symbols() -> dict[str, int]:
    """The byte that each printable stand-in means."""
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(rest)}


class Lookup:
    """A table from 64-bit keys to small numbers that looks up many keys at once."""

    _SPREAD = 0x9E3779B97F4A7C15

    def __init__(self, bits: int) -> None:
        self.bits, self.n, self.probes = bits, 0, 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, -1, np.int32)

    def add(self, key: int, value: int) -> None:
        if self.n * 2 > len(self.keys):
            old, self.probes = self.values >= 0, 1
            pairs = list(zip(self.keys[old].tolist(), self.values[old].tolist()))
            self.__init__(self.bits + 1)
            for k, v in pairs:
                self.add(k, v)
        slot, probes = (key * self._SPREAD & (1 << 64) - 1) >> (64 - self.bits), 1
        while self.values[slot] >= 0 and self.keys[slot] != key:
            slot, probes = (slot + 1) & (1 << self.bits) - 1, probes + 1
        self.n += self.values[slot] < 0
        self.keys[slot], self.values[slot] = key, value
        self.probes = max(self.probes, probes)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values of `keys`, -1 for those that are not there."""
        slot = ((keys * np.uint64(self._SPREAD)) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = self.values[slot]
        other = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        for _ in range(self.probes - 1):
            if not other.size:
                break
            slot[other] = (slot[other] + 1) & (1 << self.bits) - 1
            out[other] = self.values[slot[other]]
            other = other[(self.keys[slot[other]] != keys[other]) & (out[other] >= 0)]
        out[other] = -1
        return out


class Merges:
    """A merge list over bytes: ids, the parts of every merged token, the lookahead."""

    def __init__(self, ids: dict[bytes, int], pairs: list[tuple[bytes, bytes]]) -> None:
        self.ids = ids
        self.bytes = {i: b for b, i in ids.items()}
        self.sizes = {i: len(b) for b, i in ids.items()}
        self.longest = max(map(len, ids))
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(pairs):
            pair = (ids[left], ids[right])
            self.rank[pair] = rank
            self.merged[pair] = ids[left + right]
            self.parts.setdefault(ids[left + right], pair)
        # Tokens that their own bytes are encoded to; only these can occur in encodings.
        self.own = {i for b, i in ids.items() if self._apply(b) == [i]}
        self.lookahead = self._lookahead(pairs) + self.longest
        self.merged.clear()
        self._tails: dict[bytes, int] = {}
        self._stays: dict[tuple[int, int], bool] = {}
        self._tables = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_tails": {}, "_stays": {}, "_tables": None}

    def _apply(self, data: bytes) -> list[int]:
        """Merging by rank, as the list is defined; used for single tokens."""
        tokens = [self.ids[data[k : k + 1]] for k in range(len(data))]
        while len(tokens) > 1:
            best = min(zip(tokens, tokens[1:]), key=lambda p: self.rank.get(p, 1 << 60))
            if best not in self.rank:
                break
            done, k = [], 0
            while k < len(tokens):
                if k + 1 < len(tokens) and (tokens[k], tokens[k + 1]) == best:
                    done.append(self.merged[best])
                    k += 2
                else:
                    done.append(tokens[k])
                    k += 1
            tokens = done
        return tokens

    def _lookahead(self, pairs: list[tuple[bytes, bytes]]) -> int:
        """Bytes over which a change can travel left, by the longest chain of merges.

        A merge that now happens takes away a token which a later merge would have used
        as its right part; that merge's left part is then free for a still later one.
        """
        reach: dict[bytes, int] = {}
        for left, right in reversed(pairs):
            here = len(left) + reach.get(left, 0)
            reach[right] = max(reach.get(right, 0), here)
        return max(reach.values(), default=0)

    def stays(self, left: int, right: int) -> bool:
        """Whether these tokens stay apart side by side; remembered in `_stays`."""
        if len(self._stays) > CACHED_PIECES:
            self._stays.clear()
        known = self._stays[left, right] = self._stays_apart(left, right)
        return known

    def _stays_apart(self, left: int, right: int) -> bool:
        # Undo merges on both sides, the latest first. The border breaks if a merge across
        # it is due before the merge just undone. Equal merges happen from left to right:
        # one across the border comes after its like on the left, before its like on the right.
        due = len(self.rank)
        while True:
            if self.rank.get((left, right), due) < due:
                return False
            made = [self.rank[self.parts[t]] if t in self.parts else -1 for t in (left, right)]
            if max(made) < 0:
                return True
            if made[0] > made[1]:
                due, left = made[0], self.parts[left][1]
            else:
                due, right = made[1] + 1, self.parts[right][0]

    def encode(self, data: bytes) -> Iterator[int]:
        """The tokens of one stretch, each as soon as no later byte can change it."""
        if not self._tails:
            # Every tail of a token that can occur: its id if it is one itself, else -1.
            self._tails = {b[k:]: -1 for b, i in self.ids.items() if i in self.own for k in range(len(b))}
            self._tails |= {b: i for b, i in self.ids.items() if i in self.own}
        tail, known, size = self._tails.get, self._stays.get, self.sizes.__getitem__
        last = [0]  # last[i]: last token before position base + i
        base = 0
        for end in range(1, len(data) + 1):
            start = end
            while True:  # one token that ends here can be last: the one that fits what is before
                start -= 1
                token = tail(data[start:end], -1)
                if token >= 0:
                    if start == 0:
                        break
                    pair = (last[start - base], token)
                    fits = known(pair)
                    if fits or fits is None and self.stays(*pair):
                        break
            last.append(token)
            if end - base >= 2 * self.lookahead + FLUSH_EVERY:
                # What chains back from here and ends before the lookahead is stable.
                stable = [(stop, t) for stop, t in self._chain(last, base, end) if stop <= end - self.lookahead]
                yield from (t for _, t in stable)
                cut = stable[-1][0] - base if stable else 0
                del last[:cut]
                base += cut
        chain, end = [], len(data) - base
        while end > 0:
            token = last[end]
            chain.append(token)
            end -= size(token)
        yield from reversed(chain)

    def _prepare(self) -> None:
        """Tables for reading side by side: tokens by the hash of their bytes, known pairs."""
        self._codes = byte_codes(3)
        base = np.uint64(0xD1342543DE82EF95)
        self._steps = np.cumprod(np.full(SIDE_BY_SIDE, base), dtype=np.uint64)
        tokens = Lookup(17)
        for data, token in self.ids.items():
            if token in self.own and len(data) <= SIDE_BY_SIDE:
                codes = self._codes[np.frombuffer(data, np.uint8)][::-1]
                tokens.add(int(np.add.reduce(codes * self._steps[: len(data)], dtype=np.uint64)), token)
        self._size_of = np.zeros(max(self.sizes) + 1, np.int64)
        self._size_of[list(self.sizes)] = list(self.sizes.values())
        self._tables = (tokens, Lookup(18))

    def encode_alike(self, words: list[bytes]) -> list[list[int]]:
        """The tokens of words of one length, at most SIDE_BY_SIDE bytes; -1 fills up in front."""
        if self._tables is None or self._tables[1].n > MOST_PAIRS:
            self._prepare()
        tokens, pairs = self._tables
        width, n = len(words[0]), len(words)
        codes = self._codes[np.frombuffer(b"".join(words), np.uint8).reshape(n, width).T]
        last = np.zeros((width + 1, n), np.int32)
        for end in range(1, width + 1):
            rows, hashes = np.arange(n), np.zeros(n, np.uint64)
            for start in range(end - 1, -1, -1):
                hashes = hashes + codes[start][rows] * self._steps[end - 1 - start]
                token = tokens.get(hashes)
                fits = token >= 0
                if start:
                    some = np.flatnonzero(fits)
                    pair = (last[start][rows[some]].astype(np.uint64) << np.uint64(32)) | token[some].astype(np.uint64)
                    known = pairs.get(pair)
                    if (new := known < 0).any():
                        for p in np.unique(pair[new]).tolist():
                            pairs.add(p, int(self._stays_apart(p >> 32, p & 0xFFFFFFFF)))
                        known[new] = pairs.get(pair[new])
                    fits[some] = known == 1
                last[end][rows[fits]] = token[fits]
                if fits.all():
                    break
                rows, hashes = rows[~fits], hashes[~fits]
        chains, place, every = [], np.full(n, width), np.arange(n)
        while place.any():
            token = np.where(place > 0, last[place, every], -1)
            chains.append(token)
            place = np.where(place > 0, place - self._size_of[token], 0)
        return np.stack(chains[::-1], 1).tolist()

    def _chain(self, last: list[int], base: int, end: int) -> list[tuple[int, int]]:
        """(end, token) from `base` to `end`."""
        chain = []
        while end > base:
            token = last[end - base]
            chain.append((end, token))
            end -= self.sizes[token]
        return chain[::-1]


RUN = 256  # characters of one class that are asked about together
ASKED = 64  # runs in a question: the library's answers are large


def _class_of(asked: list[str], begins: Callable[[str], set[int]]) -> Iterator[str]:
    """L, N, P (neither) or ? (mixed) for every run of characters, as the library parts them.

    Between a letter and a digit: letters join the one, numbers the other.
    """
    for i in range(0, len(asked), ASKED):
        part = asked[i : i + ASKED]
        starts, at = begins("".join(f"a{run}1\n" for run in part)), 0
        for run in part:
            inside = any(at + k in starts for k in range(2, len(run) + 1))
            first, digit = at + 1 in starts, at + 1 + len(run) in starts
            yield "?" if inside else "L" if not first and digit else "N" if first and not digit else "P" if first else "?"
            at += len(run) + 3


def odd_characters(spec: dict) -> dict[str, str]:
    """Characters that the tokenizers library classes in another way than the regex module.

    Their Unicode tables are of different versions. L and N: letters and numbers only there;
    "not L" and "not N": only here. The library is asked about every character beyond ASCII,
    in runs that are of one class here, and one by one where a run is not of that class.
    """
    from tokenizers import Tokenizer

    # Without its vocabulary: only how it parts text is asked for.
    bare = spec | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}}
    split = Tokenizer.from_str(json.dumps(bare)).pre_tokenizer.pre_tokenize_str
    begins = lambda text: {start for _, (start, _) in split(text)}
    kinds = regex.compile(r"(?<L>\p{L}+)|(?<N>\p{N}+)|(?<P>[^\p{L}\p{N}\p{White_Space}]+)")
    beyond_ascii = "".join(
        np.arange(a, b, dtype="<u4").tobytes().decode("utf-32-le") for a, b in ((0x80, 0xD800), (0xE000, 0x110000))
    )
    runs = [
        (m.lastgroup, m.group()[k : k + RUN])
        for m in kinds.finditer(beyond_ascii)
        for k in range(0, len(m.group()), RUN)
    ]
    unclear = [(ours, run) for (ours, run), theirs in zip(runs, _class_of([r for _, r in runs], begins)) if ours != theirs]
    odd: dict[str, list[str]] = {"L": [], "N": [], "not L": [], "not N": []}
    singles = [(ours, c) for ours, run in unclear for c in run]
    for (ours, c), theirs in zip(singles, _class_of([c for _, c in singles], begins)):
        if ours != theirs:
            odd.get(theirs, []).append(c)
            odd.get(f"not {ours}", []).append(c)
    return {kind: "".join(chars) for kind, chars in odd.items()}


class Codec:
    """Encoding and decoding of texts with a byte-level BPE tokenizer file's contents."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        byte_of = byte_symbols()
        raw = {s: bytes(byte_of[c] for c in s) for s in model["vocab"] if all(c in byte_of for c in s)}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ids = {raw[s]: i for s, i in model["vocab"].items() if s in raw and s not in self.added}
        self.merges = Merges(ids, [(raw[a], raw[b]) for a, b in pairs])
        # Decimal ids as they stand in the digest, and the bytes that they mean.
        self.bytes = {str(i).encode(): b for i, b in self.merges.bytes.items()}
        self.bytes |= {str(i).encode(): s.encode() for s, i in self.added.items()}
        self.odd = odd_characters(spec)
        self._ready = False

    def _prepare(self) -> None:
        self._split = regex.compile(SPLIT)
        # The pattern for text with characters that the library classes in another way.
        self._newer = frozenset("".join(self.odd.values()))
        own = {kind: self._class(kind) for kind in "LN"}
        rest = rf"[\P{{White_Space}}--{own['L']}--{own['N']}]"
        self._split_newer = regex.compile(
            SPLIT.replace(r"[^\p{White_Space}\p{L}\p{N}]", rest)
            .replace(r" ?\p{L}+", f" ?{own['L']}+")
            .replace(r" ?\p{N}+", f" ?{own['N']}+"),
            regex.V1,
        )
        self._irregular = regex.compile(r" (?:\p{White_Space}|$)")
        self._blank = regex.compile(r"\p{White_Space}")
        found = "|".join(regex.escape(s) for s in sorted(self.added, key=len, reverse=True))
        self._special = regex.compile(f"({found})") if found else None
        # Ids with their commas; -1 is the last one, which is empty.
        self._decimal = [b"%d," % i for i in range(max(self.merges.bytes) + 1)] + [b""]
        self._fixed = {s: b"%d," % i for s, i in self.added.items()}
        self._pieces = dict(self._fixed)
        self._ready = True

    def _class(self, kind: str) -> str:
        """The library's letters or numbers: the regex module's, less what it lacks, and what it adds."""
        less, more = self.odd[f"not {kind}"], self.odd[kind]
        base = rf"[\p{{{kind}}}--[{less}]]" if less else rf"\p{{{kind}}}"
        return f"[{base}||[{more}]]" if more else f"[{base}]"

    def __getstate__(self) -> dict:
        return {"merges": self.merges, "added": self.added, "bytes": self.bytes, "odd": self.odd, "_ready": False}

    def _learn(self, pieces: set[str]) -> None:
        """Put the ids, each with a comma, of pieces that end at borders into the cache."""
        stretches = {}
        for piece in pieces:
            plain = piece.isascii() or self._newer.isdisjoint(piece)
            stretches[piece] = (self._split if plain else self._split_newer).findall(piece)
        by_size: dict[int, tuple[list[str], list[bytes]]] = {}
        for word in set().union(*stretches.values()):
            data = word.encode()
            words, coded = by_size.setdefault(len(data), ([], []))
            words.append(word)
            coded.append(data)
        known: dict[str, bytes] = {}
        decimal = self._decimal.__getitem__
        for size, (words, coded) in by_size.items():
            ids = self.merges.encode_alike(coded) if size <= SIDE_BY_SIDE else map(self.merges.encode, coded)
            known.update(zip(words, [b"".join(map(decimal, own)) for own in ids]))
        get = known.__getitem__
        for piece, own in stretches.items():
            self._pieces[piece] = get(own[0]) if len(own) == 1 else b"".join(map(get, own))

    def _borders(self, text: str) -> list[str]:
        """The text cut before every space that a word follows: always a border."""
        pieces = text.split(" ")
        rest = [" " + p for p in pieces[1:]]
        if self._irregular.search(text):
            joined = pieces[:1]
            for p in rest:
                if len(p) == 1 or self._blank.match(p, 1):
                    joined[-1] += p
                else:
                    joined.append(p)
            return [p for p in joined if p]
        return [pieces[0], *rest] if pieces[0] else rest

    def encode_all(self, texts_: list[str]) -> Iterator[bytes]:
        """Decimal ids joined by commas, of each text."""
        if not self._ready:
            self._prepare()
        first = 0
        while first < len(texts_):
            last, size = first, 0
            while last < len(texts_) and (last == first or size + len(texts_[last]) <= BLOCK_CHARS):
                size += len(texts_[last])
                last += 1
            cut = [self._cut(text) for text in texts_[first:last]]
            if len(self._pieces) > CACHED_PIECES:
                self._pieces = dict(self._fixed)
            fresh: set[str] = set()
            for pieces in cut:
                fresh |= set(pieces).difference(self._pieces)
            self._learn(fresh)
            ids = self._pieces.__getitem__
            for pieces in cut:
                yield b"".join(map(ids, pieces))[:-1]
            for piece in fresh:
                if len(piece) > CACHED_CHARS:
                    del self._pieces[piece]
            first = last

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def _cut(self, text: str) -> list[str]:
        """The pieces of a text; special tokens are pieces that are always known."""
        if not self._special or not self._special.search(text):
            return self._borders(text) if text else []
        pieces = []
        for part in self._special.split(text):
            pieces += [part] if part in self.added else self._borders(part) if part else []
        return pieces

    def decode(self, ids: bytes) -> Iterator[str]:
        """The text of decimal ids joined by commas, piece by piece."""
        machine, get = Utf8Machine(), self.bytes.__getitem__
        tokens = ids.split(b",") if ids else []
        for k in range(0, len(tokens), 8192):
            yield machine.feed(b"".join(map(get, tokens[k : k + 8192])))
        yield machine.finish()


class Utf8Machine:
    """Bytes in, text out: holds back only the bytes of one unfinished character."""

    def __init__(self) -> None:
        self._open = b""

    def feed(self, data: bytes) -> str:
        data = self._open + data
        cut = len(data)
        # A character has at most four bytes; look for a lead byte that wants more.
        for back in range(1, min(4, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                wants = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4 if byte < 0xF5 else 1
                if wants > back:
                    cut = len(data) - back
                break
            if byte < 0x80:
                break
        self._open = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self._open = self._open, b""
        return rest.decode("utf-8", "replace")


def load(path: str) -> Codec:
    with open(path, encoding="utf-8") as file:
        return Codec(json.load(file))


RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean"


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip.

    `tokenizer` is the path of a byte-level BPE tokenizer file on the driver; its
    contents (of fixed size) are broadcast. Special tokens that stand in a text are
    recognised as such; none are added. Digests are of the decimal ids joined by commas
    and of the decoded text. A null or empty text has no tokens. Rows are independent:
    repeated rows give repeated results, other columns are ignored, an empty table gives
    none, and nothing is shuffled.
    """
    # Broadcast as bytes that carry the code along: workers need not know this module.
    sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(load(tokenizer)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not hasattr(sent, "codec"):  # a worker that is used again keeps it and its caches
            sent.codec = pickle.loads(sent.value)
        own = sent.codec
        for batch in batches:
            rows = []
            listed = batch.column("text").to_pylist()
            for text, ids in zip(listed, own.encode_all(listed)):
                digest, same, place = hashlib.sha256(), True, 0
                for piece in own.decode(ids):
                    digest.update(piece.encode())
                    same = same and text.startswith(piece, place)
                    place += len(piece)
                rows.append(
                    (ids.count(b",") + 1 if ids else 0, hashlib.sha256(ids).hexdigest(), digest.hexdigest(),
                     same and place == len(text))
                )
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                 pa.array(columns[2], pa.string()), pa.array(columns[3], pa.bool_())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"],
            )

    return texts(docs).mapInArrow(run, RESULT)
