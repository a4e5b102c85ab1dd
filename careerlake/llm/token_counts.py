"""Exact token counts at every prefix of a text, by dynamic programming over byte-level BPE.

A byte string has one BPE encoding, and the last token of the encoding of its prefix of length i is
the only token t for which t ends at i, the prefix before it is encoded with last token s, and (s, t)
stays as it is when both are encoded together. So one left-to-right pass that keeps the last token
and the count of each prefix gives the exact count at all of them. Texts are first cut into the
pieces that merges never cross; a text's count at any place is the sum over the pieces before it and
one entry of a piece's table. Tables are kept for pieces that come again.

Empty and null texts have 0 tokens. A special token's own string in a text is that token, as the
tokenizer library does by default.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerlake.llm.common import as_bytes, map_arrow, texts

# Fixed values of the byte-level format: the pre-tokenizer's pattern (white space spelled out).
SPACE = "\t-\r \u0085   -     　"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
SLACK = 64  # a prefix has at most so many tokens more than a longer one: those of a special token's string, or of a piece's end
MARKS = frozenset(b".,!?;:")  # a piece and a token each, behind letters
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself if printable Latin-1, else the next from U+0100."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Kept(dict):
    """A table of computed values with two generations, so that its size is bounded and frequent keys stay."""

    def __init__(self, compute, most: int = 400_000, longest: int = 64):
        super().__init__()
        self.compute, self.most, self.longest, self.old = compute, most, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class PrefixCounter:
    """Counts tokens of prefixes with the vocabulary and merges of a tokenizers .json file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, model = byte_letters(), spec["model"]
        raw = lambda s: bytes(letters[c] for c in s)
        self.ids = {raw(s): i for s, i in model["vocab"].items()}
        self.parts = {i: b for b, i in self.ids.items()}
        self.rank, self.made, self.lefts, self.rights = {}, {}, {}, {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            a, b = raw(a), raw(b)
            pair, t = (self.ids[a], self.ids[b]), self.ids[a + b]
            self.rank[pair] = r
            self.made.setdefault(t, (r, *pair))
        self.special = [t["content"].encode() for t in spec.get("added_tokens", []) if t.get("special")]
        self.longest = max(map(len, self.ids))
        self.fits = {}
        self.spaced = re.compile(rb" (?:[\x09-\x0d ]|\Z|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2(?:\x80[\x80-\x8a\xa8\xa9\xaf]|\x81\x9f)|\xe3\x80\x80)").search
        self.white = {chr(c) for c in range(0x3001) if regex.match(rf"[{SPACE}]", chr(c))}
        self.find = regex.compile(PIECES).findall
        self.piece = Kept(lambda p: self.table(p)[-1])
        self.part = Kept(lambda p: self.count_chunk(b" " + p))

    # -- one piece ---------------------------------------------------------------------------

    def spine(self, t: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at one edge (1: left, 2: right) while t is built, each with the rank at which it ends."""
        out, until = [], 1 << 60
        while True:
            out.append((t, until))
            m = self.made.get(t)
            if m is None:
                return out
            until, t = m[0], m[side]

    def adjacent(self, s: int, t: int) -> bool:
        """Whether s, t stays s, t when the bytes of both are encoded together.

        Ranks act as time, for a merge ranks after the merges that made its parts. A merge across the border
        comes about if both of its parts stand there at its time; the left side goes first at equal ranks.
        """
        if len(self.fits) > 1_500_000:
            self.fits.clear()
        left = self.lefts.get(t)
        if left is None:
            left = self.lefts[t] = self.spine(t, 1)
        right = self.rights.get(s)
        if right is None:
            right = self.rights[s] = self.spine(s, 2)
        rank, ok = self.rank, True
        for r, r_ends in right:
            for l, l_ends in left:
                k = rank.get((r, l))
                if k is not None and k < r_ends and k <= l_ends:
                    ok = False
                    break
            if not ok:
                break
        self.fits[s, t] = ok
        return ok

    def table(self, piece: bytes) -> list[int]:
        """The count at every prefix of one piece: entry i is for its first i bytes."""
        n, ids, longest = len(piece), self.ids, self.longest
        last, count = [0] * (n + 1), [0] * (n + 1)
        get, fits, adjacent = ids.get, self.fits, self.adjacent
        for i in range(1, n + 1):
            for j in range(i - 1, max(-1, i - longest - 1), -1):  # one token fits; it is a short one mostly
                t = get(piece[j:i])
                if t is None:
                    continue
                if not j:
                    ok = True
                else:
                    ok = fits.get((last[j], t))
                    if ok is None:
                        ok = adjacent(last[j], t)
                if ok:
                    last[i], count[i] = t, count[j] + 1
                    break
        return count

    # -- texts -------------------------------------------------------------------------------

    def pieces(self, text: bytes) -> list[bytes]:
        return [p.encode() for p in self.find(text.decode())]

    def count_chunk(self, chunk: bytes) -> int:
        if chunk[1:].isalpha() and (chunk[0] == 32 or chunk[:1].isalpha()):  # ASCII letters only
            return self.piece[chunk]
        if chunk[1:-1].isalpha() and chunk[0] == 32 and chunk[-1] in MARKS:
            return self.piece[chunk[:-1]] + 1
        return sum(map(self.piece.__getitem__, self.pieces(chunk)))

    def chunks(self, text: bytes) -> list[bytes]:
        """Cuts before each space that a non-space follows; no piece crosses such a place. Without those spaces."""
        parts = text.split(b" ")
        if not self.spaced(text):
            return parts
        out: list[bytes] = []
        run: list[bytes] = []
        for p in parts:
            if out or run:
                if not p or p.decode()[0] in self.white:
                    run.append(p)
                    continue
                out.append(b" ".join(run))
            run = [p]
        out.append(b" ".join(run))
        return out

    def segments(self, text: bytes) -> list[bytes]:
        """The text between special tokens' strings; the tokens are one less."""
        out = [text]
        for s in self.special:
            out = [x for piece in out for x in piece.split(s)]
        return out

    def counts(self, segment: bytes) -> tuple[list[bytes], list[int]]:
        chunks = self.chunks(segment)
        return chunks, [self.count_chunk(chunks[0]), *map(self.part.__getitem__, chunks[1:])]

    def count(self, text: bytes) -> int:
        segments = self.segments(text)
        return len(segments) - 1 + sum(sum(self.counts(s)[1]) for s in segments if s)

    def sums(self, text: bytes) -> list[int]:
        """The count up to the end of each chunk, over all segments; the last is the text's. A special token counts with the chunk after it."""
        out: list[int] = []
        for k, s in enumerate(self.segments(text)):
            base = (out[-1] if out else 0) + (k > 0)
            out += [base + c for c in accumulate(self.counts(s)[1])] if s else [base]
        return out

    def fit(self, text: bytes, budget: int, sums: list[int] | None = None) -> tuple[int, int]:
        """The text's count, and the bytes of its longest prefix of whole characters with at most budget tokens.

        sums: those of the text, if they are known: then only the pieces around the place are looked at.
        """
        if not text:
            return 0, 0
        sums = self.sums(text) if sums is None else sums
        if any(s in text for s in self.special):
            # a special token's string has other counts while it isn't whole, so every prefix is looked at
            whole = text.decode()
            fitting = max(i for i, c in enumerate(prefix_counts(self, whole, budget)) if c <= budget)
            return sums[-1], len(whole[:fitting].encode())
        if sums[-1] <= budget:
            return sums[-1], len(text)
        chunks = self.chunks(text)
        i = bisect_right(sums, budget)  # the first chunk that doesn't fit
        start = sum(map(len, chunks[:i])) + i
        chunk = chunks[i] if i == 0 else b" " + chunks[i]
        tail = b"" if i == 0 else chunks[i - 1] if i == 1 else b" " + chunks[i - 1]
        before = sums[i - 1] if i else 0
        tail_count = before - (sums[i - 2] if i > 1 else 0)
        return sums[-1], start - (i > 0) + self.within(chunk, budget - before, tail, tail_count)

    def within(self, chunk: bytes, budget: int, tail: bytes, tail_count: int) -> int:
        """Bytes of a chunk's longest fitting prefix; tail is the chunk before it, whose count is tail_count."""
        pieces = self.pieces(chunk)
        start, used, best = 0, 0, 0
        for k, p in enumerate(pieces):
            n = self.piece[p]
            white = p.decode().isspace()
            for end in self.ends(p):
                if end == len(p) and used + n <= budget:
                    best = max(best, start + end)
            if used + n > budget or k + 1 == len(pieces) or white:
                # prefixes that end inside this piece
                table = self.table(p)
                odd = p.decode() in CONTRACTIONS
                before = pieces[k - 1] if k else b""
                for end in self.ends(p):
                    c = used + table[end]
                    if odd and end < len(p) or end == len(p) and odd:
                        c = used + self.count_chunk(p[:end])
                    elif k and before.decode().isspace() and (white or p[:end] == b" "):
                        c = used - self.piece[before] + self.count_chunk(before + p[:end])
                    elif k == 0 and p[:end] == b" " and tail and tail.decode()[-1].isspace():
                        c = self.count_chunk(tail + b" ") - tail_count
                    if c <= budget:
                        best = max(best, start + end)
            if used > budget:
                break
            used += n
            start += len(p)
        return best

    @staticmethod
    def ends(piece: bytes) -> list[int]:
        """Where a character ends."""
        return [i for i in range(1, len(piece) + 1) if i == len(piece) or piece[i] & 0xC0 != 0x80]


def prefix_counts(counter: PrefixCounter, text: str, budget: int | None = None) -> list[int]:
    """The exact token count of text[:i] for each i from 0; with a budget, up to where no longer prefix can be within it."""
    out, raw = [0], text.encode()
    base, last, last_count = 0, b"", 0
    for segment_at, segment in enumerate(counter.segments(raw)):
        if segment_at:
            mark = counter.special[0].decode()
            # a part of the mark is ordinary text, encoded with what stands before it
            out += [base - last_count + counter.count_chunk(last + mark[:i].encode()) for i in range(1, len(mark))] + [base + 1]
            base += 1
        s = segment.decode()
        known, at = 0, 0  # tokens and characters of the pieces that are over
        pieces = counter.find(s)
        for k, p in enumerate(pieces):
            table = counter.table(p.encode())
            size = 0
            for i, ch in enumerate(p, 1):
                size += len(ch.encode())
                c = known + table[size]
                if p in CONTRACTIONS:
                    c = known + counter.count_chunk(p[:i].encode())
                elif k and pieces[k - 1].isspace() and p[:i].isspace():
                    c = known - counter.piece[pieces[k - 1].encode()] + counter.count_chunk((pieces[k - 1] + p[:i]).encode())
                out.append(base + c)
            known += table[-1]
            at += len(p)
            if budget is not None and base + known > budget + SLACK:
                return out
        base += known
        chunks, counts = counter.counts(segment)
        last, last_count = chunks[-1] if len(chunks) == 1 else b" " + chunks[-1], counts[-1]
    return out


def token_counts(df: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit, fit_bytes (the bytes of the longest prefix within the limit) and prefix_tokens.

    prefix_tokens holds the count up to the end of each chunk (a word with the space before it), from which within_budget answers for any
    other budget without encoding the text again. vocabulary is the path of a byte-level BPE .json that executors can open. A null text
    is empty: 0 bytes, 0 tokens, no chunks, not over the limit. Repeated rows each give a row; other columns are ignored; an empty table
    gives an empty result. Texts of any length are done whole; memory follows the longest text.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        counter = PrefixCounter(vocabulary)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            raw = as_bytes(batch.column(1))
            sums = [counter.sums(t) if t else [] for t in raw]
            n = [x[-1] if x else 0 for x in sums]
            fits = [counter.fit(t, limit, x)[1] if c > limit else len(t) for t, x, c in zip(raw, sums, n, strict=True)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, raw), pa.int64()), pa.array(n, pa.int64()), pa.array([c > limit for c in n], pa.bool_()), pa.array(fits, pa.int64()), pa.array(sums, pa.list_(pa.int32()))],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_bytes", "prefix_tokens"],
            )

        return run

    return map_arrow(texts(df, id_col, text_col), make, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_bytes long, prefix_tokens array<int>").withColumnRenamed("doc_id", id_col)


def within_budget(counted: DataFrame, vocabulary: str, budget: Column | int, text_col: str = "text") -> DataFrame:
    """Adds fits, the bytes of the longest prefix with at most budget tokens: counted has the texts beside their prefix_tokens.

    The chunk is found in prefix_tokens; only the pieces of that one are looked at, but in texts that hold a special token's string. A null
    or negative budget, and a null text, fit 0 bytes. Further columns stay whatever their names; an empty table gives an empty result.
    """
    names, wanted = counted.columns, budget if isinstance(budget, Column) else F.lit(budget)
    plain = counted.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.coalesce(wanted.cast("int"), F.lit(-1)).alias("budget"))
    text, sums = names.index(text_col), names.index("prefix_tokens")

    def make():
        counter = PrefixCounter(vocabulary)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = zip(as_bytes(batch.column(text)), batch.column(sums), batch.column(len(names)).to_pylist(), strict=True)
            found = [counter.fit(t, n, Sums(x.values))[1] if t and n >= 0 else 0 for t, x, n in rows]
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], names=[*batch.schema.names[:-1], "fits"])

        return run

    kinds = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(counted.schema.fields))
    return map_arrow(plain, make, f"{kinds}, fits long").toDF(*names, "fits")


class Sums:
    """A list of an Arrow column, of which few entries are read."""

    def __init__(self, values: pa.Array):
        self.values = values.to_numpy(zero_copy_only=False)

    def __len__(self) -> int:
        return len(self.values)

    def __getitem__(self, i: int) -> int:
        return int(self.values[i])
