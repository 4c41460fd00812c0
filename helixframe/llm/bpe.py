"""BPE encoding and decoding by speculation and verification.

Every distinct word is first cut greedily into its longest tokens. That guess is the true BPE
segmentation exactly when each of its tokens is reachable and no merge would have crossed the
border of any two neighbours; both are checked for all words at once, with numpy, against the
merge ranks. Only words that fail are merged step by step.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents_of, small_batches, table
from .words import _SPACE as SPACE_BYTES
from .words import word_blocks

#: Text pieces a worker remembers, with their ids, before only those in use are carried over.
REMEMBERED = 400_000
#: Bytes of text encoded together: more would only cost memory.
BLOCK = 1 << 19
#: Stands for the end-of-word suffix while words are cut; a private-use character.
END = ""
NEVER = np.int64(1) << 40
#: Longer words are merged one by one.
LONG = 40


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_characters() -> list[str]:
    """The printable character that byte-level BPE writes for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


class Lookup:
    """A table from numbers (0 or more) to numbers, asked for many at once: open addressing, mostly one step a key."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int, room: int = 0):
        self.missing, self.bits = missing, max(4, max(len(keys), room).bit_length() + 2)
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, missing, np.int64)
        self.add(keys, values)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        slot = self.slots(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several keys for a slot the last stays
            settled = self.keys[slot] == keys
            self.values[slot[settled]] = values[settled]
            keys, values, slot = keys[~settled], values[~settled], (slot[~settled] + 1) & (len(self.keys) - 1)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __getitem__(self, asked: np.ndarray) -> np.ndarray:
        keys = asked.ravel()
        slot = self.slots(keys)
        there = self.keys[slot]
        found = np.where(there == keys, self.values[slot], self.missing)
        on = np.flatnonzero((there != keys) & (there >= 0))
        slot = slot[on]
        while len(on):
            slot = (slot + 1) & (len(self.keys) - 1)
            there = self.keys[slot]
            same = there == keys[on]
            found[on[same]] = self.values[slot[same]]
            more = ~same & (there >= 0)
            on, slot = on[more], slot[more]
        return found.reshape(asked.shape)


class Grown:
    """A numpy array that is appended to."""

    def __init__(self, kind: type):
        self.room, self.size = np.empty(1024, kind), 0

    def append(self, more: np.ndarray) -> None:
        if self.size + len(more) > len(self.room):
            self.room = np.concatenate([self.room[: self.size], np.empty(max(self.size, len(more)) + 1024, self.room.dtype)])
        self.room[self.size : self.size + len(more)] = more
        self.size += len(more)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run of a size, one run after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class Memory:
    """Pieces of text with their ids: the bytes of all one after the other, the ids likewise, found by hash and compared in full."""

    def __init__(self, pieces: int):
        self.number = Lookup(np.zeros(0, np.int64), np.zeros(0, np.int64), -1, room=pieces // 2)
        self.text, self.ids = Grown(np.uint8), Grown(np.uint32)
        self.columns = [Grown(np.int64) for _ in range(4)]  # of each piece start and size of its text, then of its ids

    def add(self, keys: np.ndarray, text: np.ndarray, text_sizes: np.ndarray, ids: np.ndarray, id_sizes: np.ndarray) -> None:
        first = self.columns[0].size
        starts = [self.text.size + np.cumsum(text_sizes) - text_sizes, text_sizes, self.ids.size + np.cumsum(id_sizes) - id_sizes, id_sizes]
        for column, more in zip(self.columns, starts, strict=True):
            column.append(more)
        self.text.append(text)
        self.ids.append(ids)
        self.number.add(keys, np.arange(first, first + len(keys)))

    def find(self, keys: np.ndarray, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 where it is not known."""
        found = self.number[keys]
        ours, our_sizes = self.columns[0].room, self.columns[1].room
        found[(found >= 0) & (our_sizes[found] != sizes)] = -1
        some = np.flatnonzero(found >= 0)
        if len(some):
            same = text[spread(starts[some], sizes[some])] == self.text.room[spread(ours[found[some]], sizes[some])]
            equal = np.logical_and.reduceat(same, np.cumsum(sizes[some]) - sizes[some])
            found[some[~equal]] = -1
        return found


class WordBPE:
    """A tokenizer file of the tokenizers library: NFC, lower case, words, byte-level BPE with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # White space never belongs to a word; the class is spelt out because libraries differ on it.
        blank = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
        self.words = regex.compile(split.replace("[^\\s", "[^" + blank))
        self.of_bytes = {b: c for b, c in enumerate(byte_characters()) if chr(b) != c}
        mark = lambda t: t[: -len(self.suffix)] + END if t.endswith(self.suffix) else t
        self.vocab = {mark(t): i for t, i in model["vocab"].items()}
        self.names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.grow_trie()
        self.ranks: dict[tuple[int, int], int] = {}
        size = max(self.names) + 1
        self.rank, self.left, self.right = np.full(size, -1, np.int64), np.arange(size), np.arange(size)
        keys = np.empty(len(model["merges"]), np.int64)
        made = np.empty(len(keys), np.int64)
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            self.ranks[x, y] = r
            keys[r], made[r] = x * size + y, z
            self.rank[z], self.left[z], self.right[z] = r, x, y
        self.size, self.made = size, made
        self.pair_ranks = Lookup(keys, np.arange(len(keys)), int(NEVER))
        # Ids of single characters, within a word and at its end.
        self.inner, self.final = (np.array([self.vocab.get(chr(c) + end, -1) for c in range(1024)], np.int64) for end in ("", END))
        # A token is reachable if its parts are and no earlier merge crosses their border.
        whole = self.compatible(self.left[made], self.right[made], np.arange(len(made)))
        self.reachable = np.ones(size, bool)
        for r, z in enumerate(made):
            self.reachable[z] = whole[r] and self.reachable[self.left[z]] and self.reachable[self.right[z]]
        self.memory, self.older = Memory(REMEMBERED), Memory(0)

    def rank_of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self.pair_ranks[x * self.size + y]

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge (earlier than the ranks given) crosses the border of each pair of tokens.

        The border is followed back in time: the neighbour that was formed later is taken apart
        first, and until then the pair there must not merge. Of equal ranks the leftmost merges first.
        """
        good = np.ones(len(a), bool)
        at = np.arange(len(a))
        x, y = np.asarray(a, np.int64), np.asarray(b, np.int64)
        limit = np.full(len(a), NEVER) if before is None else np.asarray(before, np.int64)
        while len(at):
            crossed = self.rank_of(x, y) < limit
            good[at[crossed]] = False
            goes_on = ~crossed & ((self.rank[x] >= 0) | (self.rank[y] >= 0))
            at, x, y = at[goes_on], x[goes_on], y[goes_on]
            rx, ry = self.rank[x], self.rank[y]
            of_x = rx > ry
            limit = np.where(of_x, rx, ry + 1)
            x, y = np.where(of_x, self.right[x], x), np.where(of_x, y, self.left[y])
        return good

    def grow_trie(self) -> None:
        """Steps (node, character) of a trie of all tokens; END is the last character code."""
        children: dict[int, int] = {}
        ends = {}
        for t, i in self.vocab.items():
            node = 0
            for c in t:
                node = children.setdefault(node << 10 | min(ord(c), 1023), len(children) + 1)
            ends[node] = i
        self.steps = Lookup(np.fromiter(children, np.int64, len(children)), np.arange(1, len(children) + 1), -1)
        self.trie_tokens = np.full(len(children) + 1, -1, np.int64)
        self.trie_tokens[list(ends)] = list(ends.values())

    def longest_tokens(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy cut of all words at once: tokens, and the word of each; END goes with the last character."""
        codes = np.minimum(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), 1023).astype(np.int64)
        stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        live, at = np.arange(len(words)), np.concatenate(([0], stop[:-1]))
        tokens, owners = [], []
        while len(live):
            node, q = np.zeros(len(live), np.int64), at.copy()
            token, next_at = np.full(len(live), -1, np.int64), at.copy()
            on = np.arange(len(live))
            while len(on):
                step = self.steps[node[on] << 10 | codes[q[on]]]
                hit = step >= 0
                on, step = on[hit], step[hit]
                node[on] = step
                q[on] += 1
                found = self.trie_tokens[step]
                full = (found >= 0) & (q[on] != stop[live[on]] - 1)
                token[on[full]], next_at[on[full]] = found[full], q[on[full]]
                on = on[q[on] < stop[live[on]]]
            tokens.append(token)
            owners.append(live)
            more = next_at < stop[live]
            live, at = live[more], next_at[more]
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(tokens)[order], owner[order]

    def merged(self, words: list[str]) -> list[list[int]]:
        """Plain BPE of words: the pair of least rank merges, leftmost first, until none is left."""
        found: list[list[int]] = [[]] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(sizes > LONG).tolist():
            found[i] = self.merged_long(self.letters(words[i]))
        # Words of like length together, so that little of the matrix is padding.
        for low, high in zip((0, 8, 11, 15, 24), (8, 11, 15, 24, LONG), strict=True):
            some = np.flatnonzero((sizes > low) & (sizes <= high)).tolist()
            if some:
                self.merge_matrix(words, some, found)
        return found

    def merge_matrix(self, words: list[str], short: list[int], found: list[list[int]]) -> None:
        flat, sizes = self.all_letters([words[i] for i in short])
        width = int(sizes.max())
        ids = np.full((len(sizes), width + 1), -1, np.int64)
        ids[np.arange(width + 1) < sizes[:, None]] = flat
        ranks = np.where((ids[:, :-1] >= 0) & (ids[:, 1:] >= 0), self.rank_of(ids[:, :-1], ids[:, 1:]), NEVER)
        live = np.arange(len(sizes))
        places = np.arange(width + 1)
        while len(live):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(live)), at]
            done = np.flatnonzero(best == NEVER)
            for i, row in zip(live[done].tolist(), ids[done].tolist(), strict=True):
                found[short[i]] = row[: row.index(-1)]
            on = best < NEVER
            live, ids, ranks, at, best = live[on], ids[on], ranks[on], at[on], best[on]
            rows = np.arange(len(live))
            ids[rows, at] = self.made[best]
            ids = np.take_along_axis(ids, np.minimum(places + (places > at[:, None]), width), axis=1)
            ranks = np.take_along_axis(ranks, np.minimum(places[:-1] + (places[:-1] >= at[:, None]), width - 1), axis=1)
            ids[:, -1], ranks[:, -1] = -1, NEVER
            for near in (at - 1, at):
                k = rows[(near >= 0) & (near < width)]
                x, y = ids[k, near[k]], ids[k, near[k] + 1]
                ranks[k, near[k]] = np.where(y >= 0, self.rank_of(x, y), NEVER)

    def all_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the characters of words, END taken with the one before it, and how many each word has."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        ends = np.flatnonzero(codes == ord(END))
        plain = np.minimum(codes, 1023)
        ids = self.inner[plain]
        ids[ends - 1] = self.final[plain[ends - 1]]
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def letters(self, word: str) -> list[int]:
        return self.all_letters([word])[0].tolist()

    def merged_long(self, ids: list[int]) -> list[int]:
        """The same for one very long word, with a heap of pairs over a linked list."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.ranks.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= n or ids[j] != y:
                continue
            ids[i], ids[j] = int(self.made[r]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (r := self.ranks.get((ids[a], ids[after[a]]))) is not None:
                    heapq.heappush(heap, (r, a, ids[a], ids[after[a]]))
        return [t for t in ids if t >= 0]

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words (byte characters, END at the end of each), one after the other, and how many each has."""
        flat, owner = self.longest_tokens(words)
        failed = np.zeros(len(words), bool)
        failed[owner[~self.reachable[flat]]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)[back]
        failed[owner[inner[~good]]] = True
        sizes = np.bincount(owner, minlength=len(words))
        if failed.any():
            again = np.flatnonzero(failed)
            merged = self.merged([words[i] for i in again.tolist()])
            kept = flat[~failed[owner]]
            sizes[again] = np.fromiter(map(len, merged), np.int64, len(merged))
            flat = np.empty(sizes.sum(), np.int64)
            of_failed = np.repeat(failed, sizes)
            flat[~of_failed] = kept
            flat[of_failed] = np.fromiter((t for m in merged for t in m), np.int64, of_failed.sum())
        return flat, sizes

    def as_words(self, text: str, found: list[str]) -> int:
        """Appends the words of a normalised text; how many there are."""
        words = [text] if text.isalpha() else self.words.findall(text)
        for w in words:
            found.append((w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.of_bytes)) + END)
        return len(words)

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces (runs of text without white space), one after the other, and how many each has."""
        # One character at a time, as the library lower-cases: no final sigma.
        low = unicodedata.normalize("NFC", " ".join(pieces)).replace("Σ", "σ").lower().split(" ")
        words: list[str] = []
        counts: list[int] = []
        special: dict[int, np.ndarray] = {}
        for k, (piece, text) in enumerate(zip(pieces, low, strict=True)):
            if text.isascii() and text.isalpha():
                words.append(text + END)
                counts.append(1)
            elif "<|" in piece:
                special[k] = np.frombuffer(self.with_special(piece), "<u4")
                counts.append(0)
            else:
                counts.append(self.as_words(text, words))
        flat, sizes = self.segment(words) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        flat = flat.astype(np.uint32)
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(counts)]
        of_piece = np.diff(ends, prepend=0)
        if special:
            parts = [special.get(k, flat[e - n : e]) for k, (e, n) in enumerate(zip(ends.tolist(), of_piece.tolist(), strict=True))]
            return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return flat, of_piece

    def with_special(self, piece: str) -> bytes:
        """Ids of a piece in which special tokens may stand."""
        ids = b""
        for part in self.special_pattern.split(piece):
            if part in self.special:
                ids += self.special[part].to_bytes(4, "little")
            elif part:
                words: list[str] = []
                self.as_words(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower(), words)
                if words:
                    ids += self.segment(words)[0].astype("<u4").tobytes()
        return ids

    def numbers(self, keys: np.ndarray, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each distinct piece in memory; those not there are taken from the older memory or encoded."""
        text = np.frombuffer(data, np.uint8)
        found = self.memory.find(keys, text, starts, sizes)
        new = np.flatnonzero(found < 0)
        if not len(new):
            return found
        if self.memory.columns[0].size + len(new) > REMEMBERED:
            self.older, self.memory = self.memory, Memory(max(REMEMBERED, len(keys)))
            new = np.arange(len(keys))
        old = self.older.find(keys[new], text, starts[new], sizes[new])
        again, fresh = new[old >= 0], new[old < 0]
        _, _, id_starts, id_sizes = (c.room for c in self.older.columns)
        parts = [(again, self.older.ids.room[spread(id_starts[old[old >= 0]], id_sizes[old[old >= 0]])], id_sizes[old[old >= 0]])]
        if len(fresh):
            parts.append((fresh, *self.ids_of([data[a:b].decode() for a, b in zip(starts[fresh].tolist(), (starts + sizes)[fresh].tolist(), strict=True)])))
        for which, ids, n in parts:
            first = self.memory.columns[0].size
            self.memory.add(keys[which], text[spread(starts[which], sizes[which])], sizes[which], ids, n)
            found[which] = first + np.arange(len(which))
        return found

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32-bit."""
        encoded: list[bytes] = []
        for w in word_blocks(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), blank=blank_bytes, block=BLOCK):
            keys, at, of = np.unique((w.hashes >> np.uint64(1)).view(np.int64), return_index=True, return_inverse=True)
            numbers = self.numbers(keys, w.data, w.starts[at], (w.ends - w.starts)[at])
            _, _, starts, sizes = (c.room for c in self.memory.columns)
            n = sizes[numbers][of]
            ids = self.memory.ids.room[spread(starts[numbers][of], n)].astype("<u4").tobytes()
            ends = (4 * np.concatenate(([0], np.cumsum(n)))[w.first]).tolist()
            encoded += [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        return encoded

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """Tokens with a blank between them, as the library decodes where a file names no decoder."""
        get = self.names.get
        return " ".join([t for t in map(get, ids if isinstance(ids, list) else ids.tolist()) if t is not None])


#: White space of more than one byte, in UTF-8: U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
WIDE_BLANKS = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_LEADS = np.zeros(256, bool)
_LEADS[[b[0] for b in WIDE_BLANKS]] = True


def blank_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text are white space."""
    blank = SPACE_BYTES[data]
    leads = np.flatnonzero(_LEADS[data])
    if len(leads):
        padded = np.append(data, np.zeros(2, np.uint8))
        seconds, thirds = padded[leads + 1], padded[leads + 2]
        for b in WIDE_BLANKS:
            hit = (data[leads] == b[0]) & (seconds == b[1])
            if len(b) == 3:
                hit &= thirds == b[2]
            for k in range(len(b)):
                blank[leads[hit] + k] = True
    return blank


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBPE:
    return WordBPE(path)


def id_lists(blobs: list[bytes]) -> pa.ListArray:
    sizes = np.fromiter((len(b) // 4 for b in blobs), np.int64, len(blobs))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(blobs), "<u4").astype(np.int32)))


def bpe_encode(docs: DataFrame, *, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) and decoded (the text of these ids) of every whole text.

    Null and empty texts, and texts of white space alone, have no ids and decode to an empty
    text. Special tokens written in a text become their ids, as the library does it. Rows that
    repeat a doc_id are encoded one by one; other columns are ignored.
    """
    path = path or default_tokenizer()
    docs = documents_of(docs)
    small_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            found = bpe.encode(batch.column(1))
            decoded = [bpe.decode(np.frombuffer(ids, "<u4")) for ids in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), id_lists(found), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return docs.mapInArrow(encode, "doc_id long, ids array<int>, decoded string")


def bpe_decode(encoded: DataFrame, *, path: str | None = None) -> DataFrame:
    """doc_id and text of the ids of each row; null ids give an empty text, ids beyond the vocabulary nothing."""
    path = path or default_tokenizer()
    encoded = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    small_batches(encoded.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bpe.decode(ids) for ids in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.mapInArrow(decode, "doc_id long, text string")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
