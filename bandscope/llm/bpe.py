"""Byte-pair encoding by longest matches and backtracking, and decoding by an offset table.

A text is cut into pretokens as the tokenizer does, and each distinct pretoken is encoded once for as
long as a worker's cache holds it. The encoder takes the longest token that begins where the last one
ended (found for every byte by one Aho-Corasick pass), and keeps it if it is compatible with the token
before: two neighbours are compatible if the merges, in order of rank, would leave both as they are. If
not, it tries the next shorter token that is a prefix; with none left it takes back the token before
and never comes to that place again. So each place is left once at most, and the work is linear in the
bytes. A sequence whose neighbours are all compatible is the one that the merges give.

Many pretokens go through the encoder side by side, one step of all of them at a time, in numpy.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandscope.llm import words as W

# How byte-level vocabularies cut a text before any merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT = regex.compile(PATTERN)
# Bytes of remembered pretokens and their ids in one worker, about.
CACHE_BYTES = 160 << 20
DECODE_IDS = 1 << 17
# With so few pretokens left, they are encoded one after another. Pairs of tokens remembered for that.
FEW = 24
PAIRS = 1 << 18
NONE = np.int64(1) << 40


def byte_letters() -> dict[str, int]:
    """The letter by which vocabulary files write each byte: itself if it prints, else the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE vocabulary file of the tokenizers library as tables.

    Tokens are numbered by when they come up: bytes first, then one for each merge, by rank; `ids` has
    their ids in the file. left and right are the two parts of a merge (a byte is its own parts), prefix
    the longest other token a token begins with.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, cutter = told["model"], told.get("pre_tokenizer") or {}
        plain = model.get("dropout") is None and not model.get("byte_fallback") and not model.get("ignore_merges")
        if model.get("type", "BPE") != "BPE" or cutter.get("type") != "ByteLevel" or told.get("normalizer") or not plain:
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        if cutter.get("add_prefix_space") or not cutter.get("use_regex", True):
            raise ValueError(f"{path}: texts are cut in a way that is not known here")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in told["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take white space or whole words only")
        letters = byte_letters()
        spelled = lambda token: bytes(letters[c] for c in token)
        self.tokens = [bytes([b]) for b in range(256)]
        number = {t: k for k, t in enumerate(self.tokens)}
        self.left, self.right = list(range(256)), list(range(256))
        for merge in model["merges"]:
            a, b = (spelled(t) for t in (merge.split(" ") if isinstance(merge, str) else merge))
            if a + b in number:
                raise ValueError(f"{path}: two merges make {a + b!r}")
            number[a + b] = len(self.tokens)
            self.tokens.append(a + b)
            self.left.append(number[a])
            self.right.append(number[b])
        file_ids = {spelled(t): i for t, i in model["vocab"].items()}
        self.ids = np.array([file_ids[t] for t in self.tokens], np.uint32)
        self.size = np.array([len(t) for t in self.tokens], np.int64)
        self.left, self.right = np.array(self.left, np.int64), np.array(self.right, np.int64)
        n = len(self.tokens)
        pairs = self.left[256:] * n + self.right[256:]
        self.pair_order = np.argsort(pairs).astype(np.int64)
        self.pairs = pairs[self.pair_order]
        self.prefix = np.array([self.shorter(t, number) for t in self.tokens], np.int64)
        self.sizes, self.prefixes = self.size.tolist(), self.prefix.tolist()
        self.asked: dict[tuple[int, int], bool] = {}
        self.finder = ahocorasick.Automaton()
        for k, token in enumerate(self.tokens):
            self.finder.add_word(token.decode("latin-1"), k)
        self.finder.make_automaton()
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        longest = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        # The bytes of every id, one after another, and where each begins.
        by_id = {int(i): t for i, t in zip(self.ids, self.tokens, strict=True)}
        by_id |= {i: t.encode() for t, i in self.added.items()}
        spoken = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.pool = np.frombuffer(b"".join(spoken), np.uint8)
        self.offsets = np.append(0, np.cumsum([len(t) for t in spoken]))

    @staticmethod
    def shorter(token: bytes, number: dict[bytes, int]) -> int:
        return next((number[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in number), -1)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that each pair merges to; NONE where it does not."""
        key = a * len(self.tokens) + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_order[at] + 256, NONE) if len(self.pairs) else np.full(len(a), NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave a and b apart when their bytes lie side by side.

        The merges inside both are undone from the latest on. A pair at the seam that merges before the
        one undone last would have been merged, so a and b would not have come up. Of equal merges the
        one further left comes first.
        """
        fine = np.ones(len(a), bool)
        left = np.arange(len(a))
        limit = np.full(len(a), NONE)
        while len(left):
            early = self.merged(a, b) < limit
            fine[left[early]] = False
            stay = ~early
            left, a, b = left[stay], a[stay], b[stay]
            # Bytes have no merge to undo. They have the lowest numbers, so only where both are bytes is one up next.
            done = (a < 256) & (b < 256)
            left, a, b = left[~done], a[~done], b[~done]
            of_a = a > b
            limit = np.where(of_a, a, b + 1)
            a, b = np.where(of_a, self.right[a], a), np.where(of_a, b, self.left[b])
        return fine

    def together(self, a: int, b: int) -> bool:
        """`compatible` for one pair, remembered."""
        found = self.asked.get((a, b))
        if found is None:
            if len(self.asked) > PAIRS:
                self.asked.clear()
            found = self.asked[a, b] = bool(self.compatible(np.array([a]), np.array([b]))[0])
        return found

    def encode_on(self, longest: list[int], ending: np.ndarray, closed: list[bool], pos: int, token: int) -> None:
        """The rest of one pretoken, from `pos` with `token` up next; writes the tokens by their ends."""
        sizes, prefix, ends, n = self.sizes, self.prefixes, ending.tolist(), len(longest) - 1
        while pos < n:
            end = pos + sizes[token]
            if not closed[end] and (pos == 0 or self.together(ends[pos], token)):
                ends[end] = token
                pos, token = end, longest[end]
            elif prefix[token] >= 0:
                token = prefix[token]
            else:
                closed[pos] = True
                token = ends[pos]
                pos -= sizes[token]
        ending[:] = ends

    def encode(self, pretokens: list[bytes]) -> list[bytes]:
        """Token ids of each pretoken (not empty), as little-endian unsigned 32-bit integers."""
        if not pretokens:
            return []
        sizes = np.array([len(p) for p in pretokens], np.int64)
        base = np.append(0, np.cumsum(sizes + 1))[:-1]
        # Matches never cross U+0100, which is no byte.
        found = self.finder.iter("Ā".join(p.decode("latin-1") for p in pretokens) + "Ā")
        flat = np.fromiter(chain.from_iterable(found), np.int64).reshape(-1, 2)
        longest = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
        # Later ends come later, so the longest token that begins at a byte is written last.
        longest[flat[:, 0] - self.size[flat[:, 1]] + 1] = flat[:, 1]
        ending = np.full(len(longest), -1, np.int64)
        closed = np.zeros(len(longest), bool)
        here, pos, token = np.arange(len(sizes)), base.copy(), longest[base]
        while len(here) > FEW:
            end = pos + self.size[token]
            before = ending[pos]
            start = pos == base[here]
            keep = ~closed[end]
            asked = np.flatnonzero(keep & ~start)
            keep[asked] = self.compatible(before[asked], token[asked])
            ending[end[keep]] = token[keep]
            shorter = self.prefix[token]
            back = ~keep & (shorter < 0)
            closed[pos[back]] = True
            token = np.where(keep, longest[end], np.where(back, before, shorter))
            pos = np.where(keep, end, np.where(back, pos - self.size[before], pos))
            go = pos < base[here] + sizes[here]
            here, pos, token = here[go], pos[go], token[go]
        for k, p, t in zip(here.tolist(), pos.tolist(), token.tolist(), strict=True):
            inside = slice(base[k], base[k] + sizes[k] + 1)
            self.encode_on(longest[inside].tolist(), ending[inside], closed[inside].tolist(), p - int(base[k]), t)
        # From the end of each pretoken back to its beginning.
        used = np.full(len(longest), -1, np.int64)
        here, pos = np.arange(len(sizes)), base + sizes
        while len(here) > FEW:
            token = ending[pos]
            pos = pos - self.size[token]
            used[pos] = token
            go = pos > base[here]
            here, pos = here[go], pos[go]
        for k, p in zip(here.tolist(), pos.tolist(), strict=True):
            ends, first = ending[base[k] : p + 1].tolist(), int(base[k])
            while p > first:
                token = ends[p - first]
                p -= self.sizes[token]
                used[p] = token
        taken = np.flatnonzero(used >= 0)
        ids = self.ids[used[taken]].astype("<u4").tobytes()
        bounds = (4 * np.searchsorted(taken, np.append(base, len(longest)))).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for, by the offset table; ids the vocabulary lacks stand for none."""
        out = []
        for at in range(0, len(ids), DECODE_IDS):
            some = ids[at : at + DECODE_IDS].astype(np.int64)
            some = some[some < len(self.offsets) - 1]
            begin = self.offsets[some]
            size = self.offsets[some + 1] - begin
            ends = np.cumsum(size)
            index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)
            out.append(self.pool[index].tobytes())
        return b"".join(out)


class Cutter:
    """Pretokens of a text as the tokenizers library finds them.

    The library and `regex` know different versions of Unicode. Each character met for the first time is asked from the
    library: beside a letter, a digit and a sign it begins a new pretoken unless it is of that class. Where the two
    disagree, a character of the library's class stands in while a text is cut.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.classified: set[str] = set(map(chr, range(128)))
        self.stand_in: dict[int, str] = {}
        self.rare: regex.Pattern | None = None

    def classify(self, texts: list[str]) -> None:
        new = sorted(set().union(*(t for t in texts if not t.isascii())) - self.classified)
        if not new:
            return
        theirs = ["\n"] * len(new)
        for beside in "!1a":
            starts = {span[0] for _, span in self.library.pre_tokenize_str("".join(beside + c for c in new))}
            theirs = [t if 2 * k + 1 in starts else beside for k, t in enumerate(theirs)]
        self.classified.update(new)
        self.stand_in |= {ord(c): t for c, t in zip(new, theirs, strict=True) if t != own_class(c)}
        if self.stand_in:
            self.rare = regex.compile("[" + "".join(regex.escape(chr(c), special_only=False) for c in self.stand_in) + "]")

    def cut(self, text: str) -> list[str]:
        if self.rare is None or text.isascii() or not self.rare.search(text):
            return CUT.findall(text)
        return [text[m.start() : m.end()] for m in CUT.finditer(text.translate(self.stand_in))]


def own_class(c: str) -> str:
    return "a" if regex.match(r"\p{L}", c) else "1" if regex.match(r"\p{N}", c) else "\n" if regex.match(r"\s", c) else "!"


class Encoder:
    """Whole texts to ids; pretokens met before are remembered."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.cutter = Cutter(path)
        self.known: dict[str, bytes] = {}
        self.weight = 0

    def learn(self, pretokens: Iterable[str]) -> None:
        new = list(set(pretokens).difference(self.known))
        ids = self.vocabulary.encode([p.encode() for p in new])
        self.known.update(zip(new, ids, strict=True))
        self.weight += 200 * len(new) + sum(map(len, new)) + sum(map(len, ids))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text, as little-endian unsigned 32-bit integers."""
        if self.weight > CACHE_BYTES:
            self.known.clear()
            self.weight = 0
        added, pattern = self.vocabulary.added, self.vocabulary.added_pattern
        self.cutter.classify(texts)
        # Added tokens stand at the odd places of a parted text; what lies between is cut as texts of their own.
        parted = [pattern.split(t) if pattern is not None else [t] for t in texts]
        inner = [[self.cutter.cut(s) for s in some[::2]] for some in parted]
        self.learn(chain.from_iterable(chain.from_iterable(inner)))
        find = self.known.__getitem__
        out = []
        for some, cuts in zip(parted, inner, strict=True):
            ids = [*map(find, cuts[0])]
            for name, after in zip(some[1::2], cuts[1:], strict=True):
                ids += [added[name].to_bytes(4, "little"), *map(find, after)]
            out.append(b"".join(ids))
        return out

    def decode(self, ids: bytes) -> str:
        """The text that ids stand for, special tokens included; broken UTF-8 becomes U+FFFD."""
        return self.vocabulary.decode(np.frombuffer(ids, "<u4")).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (binary: little-endian unsigned 32-bit integers) of every whole text.

    `path` is a byte-level BPE file of the tokenizers library, readable on all machines; the ids are those
    that the library gives without special tokens around the text. Null and empty texts have no ids. Rows
    are independent of each other: repeated rows, null and repeated doc_id come back as they are, other
    columns are left out, and an empty table gives an empty one.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for batch in batches:
            for part in W.slices(batch, "text"):
                ids = known.encode([t or "" for t in part.column("text").to_pylist()])
                counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), counts, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"]
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(W.tidy(run), f"doc_id {kind}, n_tokens long, ids binary")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids and maybe more). Null ids give a null text, no ids an empty one."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for batch in batches:
            for part in W.slices(batch, "ids"):
                texts = [None if i is None else known.decode(i) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", F.col("ids").cast("binary").alias("ids")).mapInArrow(W.tidy(run), f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of the text decoded from them, one pass, nothing shuffled."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for batch in batches:
            for part in W.slices(batch, "text"):
                ids = known.encode([t or "" for t in part.column("text").to_pylist()])
                columns = [
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(known.decode(i).encode()).hexdigest() for i in ids], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names)

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(W.tidy(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
