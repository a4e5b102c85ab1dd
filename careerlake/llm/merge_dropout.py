"""SentencePiece encoding with seeded merge-dropout, and decoding.

A text is encoded by merging neighbouring symbols, the best-scored piece first (leftmost on ties). When a candidate comes up on the
agenda it is skipped if the draw of its turn falls below the dropout rate (in steps of 1/65,536). Draws are numbered through the whole
text and keyed by the seed and the document's id, so that a seed gives the same segmentation everywhere, and other seeds, other
documents and other places in a document give others. Rate 0 gives the library's own encoding. Whatever is skipped, the pieces spell the text: characters without a piece become byte pieces, and so does
the white-space mark itself where a text holds it, so decoding gives back every text exactly.

No piece holds the mark after another character, so merges never cross the start of a word and words are encoded apart. Nor
does any cross a place where no piece has a letter followed by the character that comes next (a full stop, say): words are cut there
too. Texts of a batch that are about as long take their turns together, each turn as a few array operations over all of them
(Together). What remains (texts without company, very long parts, marks in the text) is encoded text by text: what a part becomes
follows from which of its turns are skipped, so parts are looked up by that and only encoded where it is new.
"""

from __future__ import annotations

import gc
import heapq
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import count, repeat
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from careerlake.llm.common import map_arrow, texts

MARK = "▁"
WORDS = re.compile(rf"{MARK}*[^{MARK}]+|{MARK}+")
NEVER, END = 1 << 60, 1 << 59  # no rank or unknown turns; after the last turn
ROWS = 64  # texts in a batch that a task puts out
SPAN, GROUP = 32_000_000, 3_000_000  # bytes of texts that a task takes of an Arrow batch at once, and characters that take their turns together
LEAST = 40  # so many texts pay for turns taken together
PLACE = 6  # bits for the place in a part, where turns are taken together
PART = 1 << PLACE
DRAWS = 64  # turns for which draws are made at once, a multiple of 4
NONE = (1 << 31) - 1  # no candidate
KEPT = 400_000  # words, parts and ways of a generation
DEPTH, WIDTH = 5, 7  # a way that is kept has so many skips at most, and bits for each
MADE: dict[tuple, Segmenter] = {}  # the last one of this Python worker, with what it has seen: its next task goes on with that
LETTER = re.compile(r"[^\W\d_]")
ASCII_MARKS = [chr(c) for c in range(128) if not chr(c).isalnum()]


def mixed(z: np.ndarray) -> np.ndarray:
    """64 bits each, which look random, from counters."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Segmenter:
    def __init__(self, model: str, rate: float = 0.1, seed: int = 0):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        self.ids = {p: i for i, (p, ok) in enumerate(zip(pieces, plain, strict=True)) if ok}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds the white-space mark after another character")
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}
        if len(self.bytes) < 256:
            raise ValueError("the model has no byte pieces, so not every text can be decoded")
        order = sorted(self.ids, key=lambda p: -sp.get_score(self.ids[p]))
        self.rank, last = {}, None
        for p in order:  # equal scores have equal ranks, so that the leftmost goes first
            score = sp.get_score(self.ids[p])
            if score != last:
                place, last = len(self.rank), score
            self.rank[p] = place
        self.prefix = sp.encode("a", out_type=str)[0].startswith(MARK)
        self.spell = [b""] * n
        for i, p in enumerate(pieces):
            self.spell[i] = bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode() if plain[i] else b""
        self.packed = {p: struct.pack("<i", i) for p, i in self.ids.items()}
        self.byte_ids = frozenset(self.bytes.values())
        self.packed_bytes = [struct.pack("<i", self.bytes[b]) for b in range(256)]
        follow = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if a.isalnum() and not a.isdecimal()}
        inside = {c for p in self.ids if len(p) > 1 for c in p}
        never = lambda found: re.escape("".join(c for c in ASCII_MARKS if c not in found))
        self.cut = re.compile(rf"[^\W\d_](?=[\n{never(follow)}])|[\n{never(inside)}]") if "\n" not in inside else None
        self.limit = round(rate * (1 << 16))
        strange = "ﬁ Å e\u0301"
        self.library = sp.encode if self.prefix and sp.decode(sp.encode(strange)) == strange else None  # only if it changes no character
        self.seed = seed
        self.follow, self.inside, self._together = follow, inside, None
        # words (after one mark; as they are) and their parts between cuts, in two generations: frequent ones move on when the older one goes
        self.begin, self.later, self.old_begin, self.old_later, self.made = {}, {}, {}, {}, 0
        # ids by the number of a word or part and which of its turns are skipped (way()), in two generations too
        self.ways, self.old_ways, self.numbers = {}, {}, count(1)

    def skipped(self, key: int, turns: int) -> list[int]:
        """Which of so many turns are skipped in the text of this key: 16 bits a turn, of a counter mixed with the seed and the key."""
        if not self.limit:
            return [END]
        start = xxhash.xxh64_intdigest(b"%d:%d" % (self.seed, key))
        z = np.arange(1, (turns + 3 >> 2) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(start)
        found = np.flatnonzero(mixed(z).astype("<u8", copy=False).view("<u2")[:turns] < self.limit).tolist()
        found.append(END)
        return found

    def node(self, word: str, mark: str) -> list:
        """What is known of a word: turns if nothing is skipped, ids then, its number, parts between cuts."""
        table, old = (self.begin, self.old_begin) if mark else (self.later, self.old_later)
        found = old.pop(word, None) or [NEVER, b"", next(self.numbers) << DEPTH * WIDTH, self.parts(mark + word)]
        self.made += 1
        if len(word) <= 48:
            if self.made >= KEPT:
                self.age()
                table = self.begin if mark else self.later
            table[word] = found
        return found

    def age(self) -> None:
        """A new generation begins; the older one goes."""
        self.old_begin, self.old_later, self.old_ways = self.begin, self.later, self.ways
        self.begin, self.later, self.ways, self.made = {}, {}, {}, 0

    def parts(self, word: str) -> list[tuple[str, str]] | None:
        """(mark, rest) of a word's parts, if it has a cut."""
        if not self.cut or not (found := self.cut.search(word)) or found.end() >= len(word):
            return None
        at = found.end()
        head = word[:at]
        parts = [(MARK, head[1:]) if head[0] == MARK and head[1:2] != MARK else ("", head)]
        while found := self.cut.search(word, at):
            parts.append(("", word[at : found.end()]))
            at = found.end()
        if at < len(word):
            parts.append(("", word[at:]))
        return parts

    def run(self, words: list, mark: str, key: int, turns: int) -> bytes:
        """The ids of a text's words in turn, as 4-byte numbers; bytes among them are ids already. Each word goes on with the text's draws.

        turns: a guess of how many draws there will be; it changes nothing in the result.
        """
        while True:
            skip = self.skipped(key, turns)
            out, used = self._run(words, mark, skip)
            if used <= turns or not self.limit:
                return b"".join(out)
            turns = max(2 * turns, used)

    def _run(self, words: list, mark: str, skip: list[int]) -> tuple[list[bytes], int]:
        turn, at, out = 0, 0, []
        coming, table, put = skip[0], self.begin if mark else self.later, out.append
        for word in words:
            node = table.get(word)
            if node is None:
                if word.__class__ is bytes:
                    put(word)
                    continue
                node = self.node(word, mark)
                table = self.begin if mark else self.later
            if turn + node[0] <= coming:
                put(node[1])
                turn += node[0]
                continue
            if node[3] is None:
                turn, at = self.walk(node, mark, word, turn, at, skip, put)
                coming = skip[at]
                continue
            start, first, begun = turn, at, len(out)
            for m, rest in node[3]:
                part = (self.begin if m else self.later).get(rest)
                if part is None:
                    part = self.node(rest, m)
                if turn + part[0] <= skip[at]:
                    put(part[1])
                    turn += part[0]
                else:
                    turn, at = self.walk(part, m, rest, turn, at, skip, put)
            if at == first:
                node[0], node[1] = turn - start, b"".join(out[begun:])
            coming = skip[at]
            table = self.begin if mark else self.later
        return out, turn

    def walk(self, root: list, mark: str, rest: str, turn: int, at: int, skip: list[int], put) -> tuple[int, int]:
        """Puts the ids of one part; the turn and the place in skip after it. Looks up the way that its skips make, or encodes the part."""
        way, n, i, last, bits = root[2], len(mark) + len(rest), at, turn, 0
        # a part has n - 1 merges at most, so that many turns besides those skipped; so many as it has pieces less
        while bits < DEPTH * WIDTH and skip[i] < turn + n + i - at and skip[i] - last < (1 << WIDTH) - 1:
            way |= skip[i] - last + 1 << bits
            last, i, bits = skip[i] + 1, i + 1, bits + WIDTH
            ids = self.ways.get(way)
            if ids is None:
                ids = self.old_ways.pop(way, None)
                if ids is None:
                    continue
                self.ways[way] = ids
                self.made += 1
            end = turn + n - (len(ids) >> 2) + i - at
            if end <= skip[i]:
                put(ids)
                return end, i
        end, ids = self.part(mark + rest, skip, at, turn)
        put(ids)
        way, i, last, bits = root[2], at, turn, 0
        while skip[i] < end:
            if bits == DEPTH * WIDTH or skip[i] - last >= (1 << WIDTH) - 1:
                return end, bisect_left(skip, end, i)
            way |= skip[i] - last + 1 << bits
            last, i, bits = skip[i] + 1, i + 1, bits + WIDTH
        if i == at:
            root[0], root[1] = end - turn, ids
        elif n <= 49 and end == turn + n - (len(ids) >> 2) + i - at:  # not so if some are bytes of one character
            self.ways[way] = ids
            self.made += 1
            if self.made >= KEPT:
                self.age()
        return end, i

    def segment(self, word: str, key: int = 0) -> bytes:
        """The ids of one word, its marks included, as 4-byte numbers, as the first of a text of this key."""
        return self.run([word], "", key, 2 * len(word) + 8)

    def part(self, word: str, skip: list[int], at: int, turn: int) -> tuple[int, bytes]:
        """The turn after a part that begins at this turn, before which `at` were skipped, and its ids."""
        # where nothing is skipped (there are fewer merges than symbols) the agenda gives the library's own encoding, which is taken
        n = len(word)
        if self.library and 2 < n <= 48 and skip[at] - turn >= n - 1 and word[0] == MARK and word[1:].isalpha():
            ids = self.library(word[1:])
            if self.byte_ids.isdisjoint(ids):
                return turn + n - len(ids), struct.pack(f"<{len(ids)}i", *ids)
        symbols, packed = list(word), self.packed
        symbols, turn = self._short(symbols, skip, at, turn) if n <= 64 else self._long(symbols, skip, at, turn)
        try:
            return turn, b"".join([packed[s] for s in symbols])
        except KeyError:
            return turn, b"".join([packed[s] if s in packed else b"".join([self.packed_bytes[b] for b in s.encode()]) for s in symbols])

    def merge_short(self, symbols: list[str], word: bytes, key: int) -> list[str]:
        """The pieces of one word on its own, in a text of this key; a symbol has one neighbour at first, and a merge makes two at most."""
        return self._short(symbols, self.skipped(key, 3 * len(word)), 0, 0)[0]

    def merge_long(self, symbols: list[str], word: bytes, key: int) -> list[str]:
        return self._long(symbols, self.skipped(key, 3 * len(word)), 0, 0)[0]

    def _short(self, symbols: list[str], skip: list[int], at: int, turn: int) -> tuple[list[str], int]:
        rank, coming = self.rank.get, skip[at]
        waiting = list(map(rank, map(add, symbols, symbols[1:]), repeat(NEVER)))
        while waiting:
            best = min(waiting)
            if best == NEVER:
                break
            i = waiting.index(best)
            turn += 1
            if turn > coming:
                waiting[i] = NEVER
                at += 1
                coming = skip[at]
                continue
            symbols[i] = merged = symbols[i] + symbols[i + 1]
            del symbols[i + 1], waiting[i]
            if i:
                waiting[i - 1] = rank(symbols[i - 1] + merged, NEVER)
            if i < len(waiting):
                waiting[i] = rank(merged + symbols[i + 1], NEVER)
        return symbols, turn

    def _long(self, symbols: list[str], skip: list[int], at: int, turn: int) -> tuple[list[str], int]:
        """The same with a heap: linear in the word's length but for a logarithm."""
        n, rank = len(symbols), self.rank.get
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        size = [1] * n
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (r := rank(symbols[i] + symbols[j])) is not None:
                heapq.heappush(agenda, (r, i, j, size[i], size[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, a, b = heapq.heappop(agenda)
            if size[i] != a or size[j] != b or after[i] != j:
                continue
            turn += 1
            if turn > skip[at]:
                at += 1
                continue
            symbols[i] += symbols[j]
            size[i], size[j] = a + b, 0
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s, k in zip(symbols, size, strict=True) if k], turn

    def encode(self, text: str, key: int = 0) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if self.prefix and MARK not in text and text[0] != " " and text[-1] != " " and "  " not in text:
            return np.frombuffer(self.run(text.split(" "), MARK, key, len(text) + 64), "<i4")
        mark, units = b"".join([self.packed_bytes[b] for b in MARK.encode()]), []
        for k, part in enumerate(text.split(MARK)):  # a mark in the text is written as bytes
            units += [mark] if k else []
            units += WORDS.findall((MARK if self.prefix and not k else "") + part.replace(" ", MARK))
        return np.frombuffer(self.run(units, "", key, len(text) + 64), "<i4")

    def encode_all(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """encode() of each text. Those about as long are encoded together."""
        out: list = [None] * len(texts)
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        if self._together is None:
            self._together = Together(self)
        while order:
            n = chars = 0
            while n < len(order) and (not n or chars + len(texts[order[n]]) < GROUP):
                chars += len(texts[order[n]]) + 1
                n += 1
            group, order = order[:n], order[n:]
            for i, ids in zip(group, self._together.encode([texts[i] for i in group], [keys[i] for i in group]), strict=True):
                out[i] = ids
        return out

    def encode_rest(self, rest: str, key: int, turn: int) -> np.ndarray:
        """The ids of the last parts of a text, in which marks stand for its spaces, from this turn on."""
        units, turns = WORDS.findall(rest), turn + len(rest) + 64
        while True:
            skip = self.skipped(key, turns)
            out, used = self._run(units, "", [x - turn for x in skip[bisect_left(skip, turn) :]])
            if turn + used <= turns or not self.limit:
                return np.frombuffer(b"".join(out), "<i4")
            turns = max(2 * turns, turn + used)

    def decode(self, ids) -> str:
        text = b"".join(map(self.spell.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


class Together:
    """Many texts at once: every text takes its n-th turn in the n-th step, so all have the same turn and each step is done in arrays.

    Symbols stand where their first character does; a column of the agenda has the candidates of one text's present part.
    """

    def __init__(self, s: Segmenter):
        self.s, n = s, len(s.spell)
        self.unknown = n
        self.char = np.full(0x110000, n, np.int32)
        self.kind = np.zeros(0x110000, np.uint8)  # 1: a letter, 2: no letter is followed by it in a piece, 4: in no piece but its own; 8: looked at
        for p, i in s.ids.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        for c in ["\n", *ASCII_MARKS]:
            self.kind[ord(c)] = 2 * (c == "\n" or c not in s.follow) | 4 * (c == "\n" or c not in s.inside) | 8
        self.byte_id = np.array([s.bytes[b] for b in range(256)], np.int32)
        self.by_rank = np.zeros(max(s.rank.values()) + 1, np.int32)
        rows: dict[int, list[tuple[int, int]]] = {}
        made: dict[int, int] = {}
        for p, i in s.ids.items():
            for at in range(1, len(p)):
                if (a := s.ids.get(p[:at])) is not None and (b := s.ids.get(p[at:])) is not None:
                    rows.setdefault(a, []).append((b, s.rank[p]))
                    made[i] = s.rank[p]
        for i, r in made.items():
            self.by_rank[r] = i
        # a rank tells the piece, but for runs of marks
        plain = [r for i, r in made.items() if s.spell[i].strip(b" ")]
        self.able = s.prefix and s.cut is not None and len(set(plain)) == len(plain) and max(made.values(), default=0) < 1 << 24
        self._pairs(rows)

    def _pairs(self, rows: dict[int, list[tuple[int, int]]]) -> None:
        """Ranks by pair: the row of each left piece lies at an offset of its own where it meets no other row's entries."""
        size = 1 << max(10, 2 + sum(map(len, rows.values())).bit_length())
        self.table, self.offset = np.full(size + self.unknown + 1, -1, np.int64), np.zeros(self.unknown + 1, np.int64)
        rng = np.random.default_rng(0)
        for a, row in sorted(rows.items(), key=lambda x: -len(x[1])):
            right, ranks = np.array(row, np.int64).T
            while True:
                at = int(rng.integers(size))
                if (self.table[right + at] < 0).all():
                    break
            self.table[right + at], self.offset[a] = ranks << PLACE + 32 | a, at

    def candidates(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, shifted to leave room for a place; NONE if it makes no piece."""
        found = self.table.take(self.offset.take(left) + right)
        return np.where(found & 0xFFFFFFFF == left, found >> 32, NONE)

    def encode(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        fit = [i for i, t in enumerate(texts) if self.able and t and MARK not in t and t[0] != " " and "  " not in t]
        if len(fit) >= LEAST:
            for i, ids in zip(fit, self._encode([texts[i] for i in fit], [keys[i] for i in fit]), strict=True):
                out[i] = ids
        return [self.s.encode(t, k) if x is None else x for t, k, x in zip(texts, keys, out, strict=True)]

    def _encode(self, texts: list[str], keys: list[int]) -> list[np.ndarray | None]:
        joined = "".join([MARK + t.replace(" ", MARK) for t in texts])
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        n, ends = len(points), np.cumsum([len(t) + 1 for t in texts])
        begins = np.concatenate([[0], ends[:-1]])
        kind = self.kind[points]
        if not kind.all():
            for c in np.unique(points[kind == 0]).tolist():
                self.kind[c] = 8 | (LETTER.match(chr(c)) is not None)
            kind = self.kind[points]
        # parts: from a mark, or after a cut
        first = points == ord(MARK)
        first[1:] |= (kind[:-1] & (kind[1:] >> 1) & 1 | kind[:-1] & 4) != 0
        starts = np.flatnonzero(first)
        sizes = np.diff(starts, append=n)
        symbol = self.char[points]
        strange = (symbol == self.unknown).nonzero()[0]
        points = points[strange]
        del first, kind
        queue = np.full(n + PART, NONE, np.int32)
        for at in range(0, n - 1, 1 << 18):
            to = min(at + (1 << 18), n - 1)
            queue[at:to] = self.candidates(symbol[at:to], symbol[at + 1 : to + 1])
        queue[starts[1:] - 1] = NONE
        busy = np.minimum.reduceat(queue[:n], starts) != NONE
        starts_b, sizes_b = starts[busy], sizes[busy]
        for at in range(0, len(starts), 1 << 16):  # each candidate's place in its part; NONE stays
            to = min(at + (1 << 16), len(starts))
            a, b = int(starts[at]), int(starts[to]) if to < len(starts) else n
            queue[a:b] |= (np.arange(a, b) - np.repeat(starts[at:to], sizes[at:to]) & PART - 1).astype(np.int32)
        after, before, alive = np.ones(n, np.int8), np.ones(n, np.int8), np.ones(n, bool)
        after[starts[1:] - 1], before[starts], after[n - 1] = 0, 0, 0
        here, last = np.searchsorted(starts_b, begins), np.searchsorted(starts_b, ends)
        alone = np.zeros(len(texts), bool)
        alone[np.searchsorted(ends, starts_b[sizes_b > PART], "right")] = True
        texts_on = np.flatnonzero((here < last) & ~alone)
        left = self._turns(symbol, queue, after, before, alive, starts_b, sizes_b, here[texts_on], last[texts_on], [keys[i] for i in texts_on.tolist()])
        out = self._ids(points, strange, symbol, alive, begins)
        for i in np.flatnonzero(alone).tolist():
            out[i] = None
        for lane, at, turn in left:
            i = int(texts_on[lane])
            a, b = np.searchsorted(strange, (begins[i], at))
            done = self._ids(points[a:b], strange[a:b] - begins[i], symbol[begins[i] : at], alive[begins[i] : at], np.zeros(1, np.int64))[0] if at > begins[i] else out[i][:0]
            out[i] = np.concatenate([done, self.s.encode_rest(joined[at : ends[i]], keys[i], turn)])
        return out

    def _ids(self, points: np.ndarray, strange: np.ndarray, symbol: np.ndarray, alive: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
        """The ids of the symbols that are left, by text; unknown characters, of these code points at these places, as bytes."""
        many = alive.astype(np.int8)
        if len(strange):
            many[strange] = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            ids = np.repeat(symbol, many)
            ids[ids == self.unknown] = self.byte_id[np.frombuffer(points.tobytes().decode("utf-32-le").encode(), np.uint8)]
        else:
            ids = symbol[alive]
        return np.split(ids, np.cumsum(np.add.reduceat(many, begins, dtype=np.int64))[:-1])

    def _turns(self, symbol, queue, after, before, alive, starts, sizes, here, last, keys) -> list[tuple[int, int, int]]:
        """Takes all turns, changing the arrays. What is left when too few texts go on: number, the place of the present part, its first turn."""
        s, m = self.s, len(here)
        if not m:
            return []
        first = np.array([xxhash.xxh64_intdigest(b"%d:%d" % (s.seed, k)) for k in keys], np.uint64)
        lane, base, since = np.arange(m), starts.take(here), np.zeros(m, np.int64)
        nothing, n = len(starts), len(symbol)
        starts, sizes = np.append(starts, n), np.append(sizes, 1)
        queue[n] = 0
        here = here - 1  # the parts before the first ones are done
        agenda = np.full((int(sizes[sizes <= PART].max()), m), NONE, np.int32)
        rows, count, turn = np.arange(PART)[:, None], np.arange(m), 0
        flat = agenda.reshape(-1)
        while True:
            if not turn % DRAWS:
                go = (here < last).nonzero()[0]
                if len(go) < m:
                    lane, base, since, here, last, first = (x.take(go) for x in (lane, base, since, here, last, first))
                    agenda, m = agenda.take(go, axis=1), len(go)
                    flat, count = agenda.reshape(-1), count[:m]
                if m < LEAST:
                    return list(zip(lane.tolist(), base.tolist(), since.tolist(), strict=True))
                drawn = self._taken(first, turn)
            best = agenda.min(0)
            empty = (best == NONE).nonzero()[0]
            if len(empty):
                now = here.take(empty)
                now += 1
                over = (now >= last.take(empty)).nonzero()[0]
                if len(over):
                    now[over] = last.take(empty.take(over))
                here[empty] = now
                if len(over):  # ended texts stay for a while, with a candidate that is always skipped
                    now[over] = nothing
                    drawn[:, empty.take(over)] = False
                at, size = starts.take(now), sizes.take(now)
                base[empty], since[empty] = at, turn
                r = rows[: size.max()]
                new = queue.take(at + r)
                new[r >= size] = NONE
                agenda[: len(r), empty] = new
                best[empty] = new.min(0)
            on = drawn[turn % DRAWS].nonzero()[0]
            turn += 1
            best = best.astype(np.int64)
            place = best & PART - 1
            cell = place * m
            cell += count
            flat[cell] = NONE  # a candidate that is skipped
            if not len(on):
                continue
            place, cell, i = place.take(on), cell.take(on), (base + place).take(on)
            merged = self.by_rank.take(best.take(on) >> PLACE)
            step, back = after.take(i), before.take(i)
            j = i + step
            beyond = after.take(j)
            k = j + beyond
            symbol[i] = merged
            alive[j] = False
            wide = step + beyond
            ended = (beyond == 0).nonzero()[0]
            wide[ended] = 0
            after[i] = wide
            before[k] = wide
            right = symbol.take(k)
            right[ended] = self.unknown
            n = len(on)
            left = np.concatenate([symbol.take(i - back), merged])
            found = self.candidates(left, np.concatenate([left[n:], right]))
            flat[cell + np.multiply(step, m, dtype=np.int64)] = NONE
            to_left = found[:n]
            to_left |= place - back
            flat[cell - np.multiply(back, m, dtype=np.int64)] = to_left  # at the symbol's own place if none is before it; the next line sets that
            to_right = found[n:]
            to_right |= place
            flat[cell] = to_right

    def _taken(self, first: np.ndarray, turn: int) -> np.ndarray:
        """Which of the next turns aren't skipped: a row for each turn, a column for each text. As Segmenter.skipped() has them."""
        z = first[:, None] + np.arange((turn >> 2) + 1, (turn + DRAWS >> 2) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return np.ascontiguousarray((mixed(z).astype("<u8", copy=False).view("<u2") >= self.s.limit).T)


def segmentations(docs: DataFrame, model: str, rate: float = 0.1, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, ids (array of piece ids), n_pieces, digest (crc32 of the ids as 4-byte numbers) and lossless.

    A text's draws are keyed by the hash of its id; rows of one id have the same ones. lossless: decoding the ids gives the text. Null and empty texts have no pieces
    and are lossless. Repeated rows each give a row; further columns are ignored; an empty table gives an empty result; texts are
    encoded whole.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def spans(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ends, at = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, SPAN + (ends[at - 1] if at else 0), "right")))
            yield batch.slice(at, to - at)
            at = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (model, rate, seed) not in MADE:
            MADE.clear()
            MADE[model, rate, seed] = Segmenter(model, rate, seed)
        s = MADE[model, rate, seed]
        for span in (x for b in batches for x in spans(b)):
            raw = span.column(1).to_pylist()
            keys = [xxhash.xxh64_intdigest(b"" if i is None else str(i).encode()) for i in span.column(0).to_pylist()]
            gc.disable()  # nodes make no cycles, and looking for some in them takes a third of the time
            try:
                encoded = s.encode_all(raw, keys)
            finally:
                gc.enable()
            for at in range(0, len(raw), ROWS):
                ids, own = encoded[at : at + ROWS], raw[at : at + ROWS]
                n = list(map(len, ids))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(np.concatenate(ids)))
                same = [s.decode(i) == t for i, t in zip(ids, own, strict=True)]
                yield pa.RecordBatch.from_arrays([span.column(0).slice(at, ROWS), pa.array(map(len, own), pa.int64()), lists, pa.array(n, pa.int64()), pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()), pa.array(same)], names=["doc_id", "n_chars", "ids", "n_pieces", "digest", "lossless"])

    return texts(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_chars long, ids array<int>, n_pieces long, digest long, lossless boolean").withColumnRenamed("doc_id", id_col)


def decoded(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """Adds text, decoded from the piece ids; a null list gives a null text."""
    schema = encoded.drop("text").schema.add("text", "string")

    def make():
        s = Segmenter(model)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [None if i is None else s.decode(i) for i in batch.column(batch.schema.get_field_index(ids_col)).to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "text"])

        return run

    return map_arrow(encoded.drop("text"), make, schema)
