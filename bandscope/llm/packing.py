"""Best-fit packing of tokenised documents into sequences, after a Martello-Toth dominance reduction.

A piece of a document matters to the packing only by its length, and there are at most `capacity`
lengths. So the packing is computed on the counts by length, a table whose size does not depend on the
corpus, and says for each run of pieces of one length (by rank) which sequences they go to, and where.
Pieces get their rank within their length from counts by (salt, length) and a sort within those small
groups, so a length that a third of all pieces have is spread over the salts.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandscope.llm import words as W
from bandscope.llm.columns import set_aside
from bandscope.session import stored

CAPACITY = 2048
END = 0
# Pieces in a (salt, length) group at most, about.
GROUP = 20_000


# -- tokens


LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
STOP = np.zeros(256, bool)
STOP[list(b".,;:!?")] = True
LATIN = np.zeros(256, bool)
LATIN[0x80:0xC0] = True
LATIN[[0x97, 0xB7]] = False  # the signs for times and divided by


def letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of the letters of U+00C0 to U+00FF."""
    out = LETTER[data]
    two = np.flatnonzero((data[:-1] == 0xC3) & LATIN[data[1:]])
    out[two] = True
    out[two + 1] = True
    return out


class ChunkCache:
    """Token ids of the runs of a text that the tokenizer handles on their own, found again by hash.

    The tokenizer drops white space before it merges anything, and parts a stop from the letter before
    it, so the ids of a text are those of its chunks in a row: runs without white space, less one stop
    at the end after a letter, and that stop. Chunks repeat, and each distinct one goes through the
    tokenizer once per worker. The cache starts anew when it is full, so memory is bounded; results do
    not depend on it.
    """

    SLOTS = 1 << 21
    ENTRIES = 1 << 20

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.clear(self.ENTRIES)

    def clear(self, room: int) -> None:
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.entry = np.full(self.SLOTS, -1, np.int32)
        self.begin = np.zeros(room, np.int64)
        self.size = np.zeros(room, np.int32)
        self.pool = np.zeros(1 << 20, np.uint32)
        self.n = self.used = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where there is none."""
        found = np.full(len(hashes), -1, np.int32)
        slot = (hashes >> np.uint64(43)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            entry = self.entry[slot]
            hit = self.keys[slot] == hashes[left]
            found[left[hit]] = entry[hit]
            go = ~hit & (entry >= 0)
            left, slot = left[go], (slot[go] + 1) % self.SLOTS
        return found

    def encoded(self, chunks: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and how many each has. Plain chunks are letters alone."""
        if plain:
            # A word of letters is merged by itself, and its last id is one that closes a word.
            ids = np.array(self.tokenizer.encode(" ".join(chunks), add_special_tokens=False).ids, np.int64)
            last = np.flatnonzero(self.closes[ids])
            if len(last) == len(chunks):
                return ids, np.diff(last, prepend=-1)
        found = self.tokenizer.encode(chunks, is_pretokenized=True, add_special_tokens=False)
        owner = np.array(found.word_ids, np.int64)
        return np.array(found.ids, np.int64), np.bincount(owner, minlength=len(chunks))

    def add(self, hashes: np.ndarray, chunks: list[str], plain: bool) -> None:
        """Entries for distinct hashes that have none."""
        for at in range(0, len(chunks), 4096):
            ids, sizes = self.encoded(chunks[at : at + 4096], plain)
            while self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
            self.pool[self.used : self.used + len(ids)] = ids
            n = len(sizes)
            self.begin[self.n : self.n + n] = self.used + np.cumsum(sizes) - sizes
            self.size[self.n : self.n + n] = sizes
            self.used += len(ids)
            left, slot = np.arange(n), (hashes[at : at + n] >> np.uint64(43)).astype(np.int64)
            while len(left):
                # Of several that want a free slot one gets it; the others go on to the next.
                free = np.flatnonzero(self.entry[slot] < 0)
                self.entry[slot[free]] = self.n + left[free]
                got = self.entry[slot] == self.n + left
                self.keys[slot[got]] = hashes[at + left[got]]
                left, slot = left[~got], (slot[~got] + 1) % self.SLOTS
            self.n += n

    def ids(self, col: W.Column) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all rows, one after another, and where each row begins (rows + 1 entries)."""
        data = col.data
        plain = letters(data)
        stop = np.flatnonzero(STOP[data])
        stop = stop[(stop > 0) & ~np.isin(stop, col.offsets)]
        stop = stop[plain[stop - 1]]
        after = np.minimum(stop + 1, len(data) - 1)
        stop = stop[~W.SOLID_BYTES[data[after]] | np.isin(stop + 1, col.offsets)]
        # Special tokens are told by case, and hold this sign; other text is lower-cased by the tokenizer.
        fold = W.SAME if (data == 0x7C).any() else W.LOWER
        start, end, hashes, first = W.spans(col, W.SOLID_BYTES, fold, stop)
        found = self.find(hashes)
        if (found < 0).any():
            new = np.flatnonzero(found < 0)
            keys, where = np.unique(hashes[new], return_index=True)
            if self.n + len(keys) > self.ENTRIES:
                keys, where = np.unique(hashes, return_index=True)
                new = np.arange(len(hashes))
                self.clear(max(self.ENTRIES, len(keys)))
            at = new[where]
            simple = np.append(0, np.cumsum(plain, dtype=np.int64))
            simple = simple[end[at]] - simple[start[at]] == end[at] - start[at]
            for kind in (True, False):
                some = at[simple == kind]
                texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(start[some], end[some], strict=True)]
                self.add(keys[simple == kind], texts, kind)
            found = self.find(hashes)
        sizes = self.size[found].astype(np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        index = np.arange(total) + np.repeat(self.begin[found] - (ends - sizes), sizes)
        return self.pool[index], np.append(0, ends)[first]


@lru_cache(maxsize=2)
def cache(path: str) -> ChunkCache:
    return ChunkCache(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every document: its token ids, then one id 0, cut every `capacity` tokens.

    Null and empty texts are the single id 0. Returns doc_id, piece, start, length, ids_crc32; doc_id must be a whole
    number or null, repeated rows are cut as often, and other columns are left out.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = cache(tokenizer)
        for batch in batches:
            for part in W.slices(batch, "text", 2 << 20):
                ids, first = known.ids(W.column(part.column("text")))
                out: list[tuple] = []
                for row, name in enumerate(part.column("doc_id").to_pylist()):
                    own = np.append(ids[first[row] : first[row + 1]], END).astype("<u4")
                    for piece, at in enumerate(range(0, len(own), capacity)):
                        some = own[at : at + capacity]
                        out.append((name, piece, at, len(some), zlib.crc32(some)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return rows.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(W.tidy(cut), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


# -- packing of counts by length


class Runs:
    """Sequences alike: for each free room the sequences (first, count) that have it, and what was put where."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()
        self.rank = np.zeros_like(counts)
        self.placed: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0

    def put(self, length: int, n: int, sequence: int, offset: int) -> None:
        """The next n pieces of a length, one into each of n sequences from `sequence` on."""
        self.placed.append((length, int(self.rank[length]), n, sequence, offset))
        self.rank[length] += n
        self.left[length] -= n

    def open(self, lengths: tuple[int, ...], n: int) -> int:
        """n new sequences that hold one piece of each of the lengths; the first one's number."""
        first, offset = self.sequences, 0
        self.sequences += n
        for length in lengths:
            self.put(length, n, first, offset)
            offset += length
        return first


def sum_of_smallest(left: np.ndarray, present: np.ndarray, k: int) -> int:
    """Length of the k shortest pieces together; beyond any room if there are fewer."""
    total = 0
    for length in present[:k].tolist():
        some = min(k, int(left[length]))
        total, k = total + some * length, k - some
        if not k:
            return total
    return 1 << 60


def dominating_set(left: np.ndarray, j: int, capacity: int) -> tuple[int, ...] | None:
    """A set of at most three pieces with one of length j that dominates every other such set, if there is a simple one.

    `left` counts the pieces besides that one. A set dominates another if its pieces can be matched to the
    other's so that none is shorter. With i the longest piece that fits beside j:
    nothing fits: {j}. {j, i} if i fills the sequence, or no two pieces fit beside j together.
    {j, i, b} if no three fit, b is the longest that fits beside j and i, and no two pieces longer than b
    fit beside j together: any pair then has a part of at most b, and its other part is at most i.
    """
    room = capacity - j
    present = np.flatnonzero(left)
    present = present[:bisect_right(present, room)]
    if not len(present):
        return (j,)
    i = int(present[-1])
    if i == room or sum_of_smallest(left, present, 2) > room:
        return (j, i)
    if sum_of_smallest(left, present, 3) <= room:
        return None
    left[i] -= 1
    fit = present[(present <= room - i) & (left[present] > 0)]
    left[i] += 1
    if not len(fit):
        return None
    b = int(fit[-1])
    if sum_of_smallest(left, present[present > b], 2) <= room:
        return None
    return (j, i, b)


def reduce_dominated(runs: Runs, capacity: int) -> None:
    """Fix dominating sets, from the longest piece down, until no piece has one. Equal sets are fixed at once:
    taking pieces away keeps every condition of `dominating_set`."""
    changed = True
    while changed:
        changed = False
        for j in np.flatnonzero(runs.left)[::-1].tolist():
            while runs.left[j]:
                runs.left[j] -= 1
                found = dominating_set(runs.left, j, capacity)
                runs.left[j] += 1
                if found is None:
                    break
                runs.open(found, min(int(runs.left[x]) // found.count(x) for x in found))
                changed = True


def best_fit(runs: Runs, capacity: int) -> None:
    """Best-fit decreasing of what is left: each piece into the fullest sequence that has room, else a new one.

    Sequences with equal room are handled together: some get as many pieces of the length as they hold,
    and at most one gets fewer.
    """
    free: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def add(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in free:
                free[room] = []
                rooms.insert(bisect_right(rooms, room), room)
            free[room].append((first, n))

    for length in np.flatnonzero(runs.left)[::-1].tolist():
        while runs.left[length]:
            want = int(runs.left[length])
            at = bisect_right(rooms, length - 1)
            if at < len(rooms):
                room = rooms[at]
                first, n = free[room].pop()
                if not free[room]:
                    del free[room]
                    rooms.pop(at)
            else:
                room, first, n = capacity, runs.sequences, -(-want // (capacity // length))
                runs.sequences += n
            fits = room // length
            full = min(n, want // fits)
            rest = want - full * fits if full < n else 0
            for k in range(fits if full else 0):
                runs.put(length, full, first, capacity - room + k * length)
            for k in range(rest):
                runs.put(length, 1, first + full, capacity - room + k * length)
            add(room - fits * length, first, full)
            add(room - rest * length, first + full, 1 if rest else 0)
            add(room, first + full + (1 if rest else 0), n - full - (1 if rest else 0))


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Placements (length, first rank, pieces, first sequence, offset) of counts[length] pieces, and the number of sequences."""
    runs = Runs(counts)
    reduce_dominated(runs, capacity)
    best_fit(runs, capacity)
    return sorted(runs.placed), runs.sequences


def pack(cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Every piece with `sequence_id` and `offset`. `cut` has doc_id, piece, start, length and maybe more; length is 1..capacity.

    Pieces alike in length are interchangeable; ties go by salt, doc_id, piece and ids_crc32. Columns named
    sequence_id or offset before are replaced, all others come back.
    """
    spark = cut.sparkSession
    kept = [c for c in cut.columns if c not in ("sequence_id", "offset")]
    cut, other = set_aside(cut.select(*(F.col(f"`{c}`") for c in kept)), ("_salt", "_n", "_at", "_base", "_to"))
    total = cut.count()
    salts = max(64, -(-total // group))
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    by_salt = stored(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    # At most `capacity` rows.
    for row in by_salt.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    placed, _ = plan(counts, capacity)
    table = spark.sparkContext.broadcast(np.array(placed, np.int64).reshape(-1, 5))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        rows = table.value
        # Ranks stay below 2 ** 48, lengths below 2 ** 15.
        at = np.searchsorted((rows[:, 0] << 48) + rows[:, 1], (length.to_numpy() << 48) + rank.to_numpy(), "right") - 1
        return pd.DataFrame({"sequence_id": rows[at, 3] + rank.to_numpy() - rows[at, 1], "offset": rows[at, 4]})

    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_salt.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    return (
        salted.withColumn("_at", F.row_number().over(inside) - 1)
        .join(bases, ["length", "_salt"])
        .withColumn("_to", place("length", F.col("_base") + F.col("_at")))
        .select(
            *(F.col(f"`{other.get(c, c)}`").alias(c) for c in kept),
            F.col("_to.sequence_id").alias("sequence_id"),
            F.col("_to.offset").alias("offset"),
        )
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Pieces of all `docs` (doc_id, text), tokenised once, each with its place. An empty table has no rows."""
    return pack(stored(pieces(docs, tokenizer, capacity), "pieces"), capacity, group)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer file, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)
