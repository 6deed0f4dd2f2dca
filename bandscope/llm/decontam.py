"""Benchmark decontamination with suffix arrays of the training texts.

Every task cuts its documents into shards of some megabytes, sorts the suffixes of a shard's words and
binary-searches every test suffix in it: first the interval of suffixes with the same first word, then
inside it those with the same second word, and so on. An interval that is left after a window's words
holds all places of that window; from there each match is prolonged to its longest verbatim length.
Suffixes are ordered by their first `window` words or more, all that the search looks at. Documents
stay where they are: there is no shuffle, whatever passages they share. Words are compared by 64-bit
hashes.

The test items are read and broadcast in blocks of bounded size, one pass over the documents for each block.
What a pass found is written before the next block is broadcast, and the copy before it is deleted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandscope.llm import words as W
from bandscope.llm.columns import put_back, set_aside
from bandscope.session import release, scratch_path

WINDOW = 10
# Text of the items in one broadcast block, in bytes.
BLOCK_BYTES = 8 << 20


@dataclass
class Items:
    """Test suffixes: `words` of all items in a row, and for each suffix its place, item, item's end and window."""

    words: np.ndarray
    at: np.ndarray
    item: np.ndarray
    end: np.ndarray
    window: np.ndarray
    names: list[str]


def prepare(rows: list[tuple[str, str]], window: int) -> Items:
    col = W.column(pa.array([text for _, text in rows], pa.string()))
    _, _, hashes, first = W.words(col)
    at, item, size = [], [], []
    for k, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        n = min(window, b - a)
        if n:
            begins = np.arange(a, b - n + 1)
            at.append(begins)
            item.append(np.full(len(begins), k))
            size.append(np.full(len(begins), n))
    none = [np.zeros(0, np.int64)]
    item = np.concatenate(item or none)
    return Items(hashes, np.concatenate(at or none), item, first[1:][item], np.concatenate(size or none), [name for name, _ in rows])


def suffix_array(ids: np.ndarray, distinct: int, depth: int) -> np.ndarray:
    """Positions in the order of the words from there on, by at least `depth` words. `ids` are 0 .. distinct - 1."""
    n, bits = len(ids), max(1, int(distinct).bit_length())
    first = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(first):
        key <<= bits
        if k < n:
            key[: n - k] |= ids[k:] + 1
    done = first
    while True:
        order = np.argsort(key)
        if done >= depth:
            return order
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(1, ranked[1:] != ranked[:-1]))
        if rank.max(initial=0) == n:
            return order
        key = rank << 32
        if done < n:
            key[: n - done] |= rank[done:]
        done *= 2


def narrowed(words: np.ndarray, order: np.ndarray, depth: int, lo: np.ndarray, hi: np.ndarray, word: np.ndarray, after: bool) -> np.ndarray:
    """In each interval [lo, hi) of suffixes with `depth` words in common, the first whose next word is `word` or more (or more only)."""
    lo, hi = lo.copy(), hi.copy()
    last = len(words) - 1
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        place = order[np.minimum(mid, len(order) - 1)] + depth
        found = np.where(place <= last, words[np.minimum(place, last)], -1)
        right = open_ & ((found <= word) if after else (found < word))
        lo = np.where(right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)


def shard_matches(hashes: np.ndarray, first: np.ndarray, items: Items, window: int) -> tuple[np.ndarray, ...]:
    """All places of test windows in a shard: test suffix, shard position and longest match, in words.

    `first` has the first word of each document and the end. No match crosses a document's end.
    """
    none = np.zeros(0, np.int64)
    if not len(hashes) or not len(items.at):
        return none, none, none
    vocabulary, ids = np.unique(hashes, return_inverse=True)
    known = np.searchsorted(vocabulary, items.words)
    test = np.where(vocabulary[np.minimum(known, len(vocabulary) - 1)] == items.words, known, -2)
    # Each document ends in a sign of its own number, so that suffixes do not run on into the next one.
    sizes = np.diff(first)
    kept = np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)
    words = np.full(len(ids) + len(sizes), len(vocabulary), np.int64)
    words[kept] = ids
    order = suffix_array(words, len(vocabulary) + 1, window)
    query = np.arange(len(items.at))
    lo, hi = np.zeros(len(query), np.int64), np.full(len(query), len(order))
    found = []
    for depth in range(window):
        word = test[items.at[query] + depth]
        lo, hi = narrowed(words, order, depth, lo, hi, word, False), narrowed(words, order, depth, lo, hi, word, True)
        live = lo < hi
        whole = live & (items.window[query] == depth + 1)
        found.append((query[whole], lo[whole], hi[whole]))
        live &= ~whole
        query, lo, hi = query[live], lo[live], hi[live]
        if not len(query):
            break
    query, lo, hi = (np.concatenate(x) for x in zip(*found, strict=True))
    many = hi - lo
    q = np.repeat(query, many)
    place = order[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)]
    length = items.window[q]
    going = np.arange(len(q))
    while len(going):
        a, b = items.at[q[going]] + length[going], place[going] + length[going]
        inside = (a < items.end[q[going]]) & (b < len(words))
        going, a, b = going[inside], a[inside], b[inside]
        going = going[test[a] == words[b]]
        length[going] += 1
    # Back to positions without the signs.
    return q, np.searchsorted(kept, place), length


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


FOUND = "n_words long, hits array<struct<start:long,end:long>>, matches array<struct<item_id:string,item_word:long,doc_word:long,n_words:long>>"


def blocks(items: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple[str, str]]]:
    """Distinct items with text, some megabytes at a time."""
    some, size = [], 0
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(text).alias("words"))
    for row in rows.filter("words IS NOT NULL").distinct().orderBy("name", "words").toLocalIterator():
        some.append((row["name"], row["words"]))
        size += len(row["words"].encode())
        if size >= limit:
            yield some
            some, size = [], 0
    if some:
        yield some


def find_matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK_BYTES
) -> DataFrame:
    """`docs` with `n_words`, `hits` and `matches`; columns of these names before are replaced.

    hits: ranges [start, end) of the document's words inside any place of a window (`window` consecutive
    words of an item; an item of fewer words, but not none, is one window). matches: for each item with a
    window here its longest match in words, the first of equal ones, sorted by item. Null texts and items
    have no words. Repeated rows are judged alike; items with one id count as one; a null item id is "".
    """
    spark = docs.sparkSession
    out = docs.select(*(c for c in docs.columns if c not in ("n_words", "hits", "matches")))
    base = out.schema
    out = out.select("*", F.expr("0L AS n_words"), F.expr("CAST(array() AS array<struct<start:long,end:long>>) AS hits"), F.expr("CAST(array() AS array<struct<item_id:string,item_word:long,doc_word:long,n_words:long>>) AS matches"))
    kept = base.fieldNames()
    left = blocks(items, item_id, item_text, block)
    rows, written = next(left, []), None
    while rows is not None:
        shared = spark.sparkContext.broadcast(prepare(rows, window))
        schema = out.schema

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                for part in W.slices(batch, text):
                    _, _, hashes, first = W.words(W.column(part.column(text)))
                    q, place, length = shard_matches(hashes, first, known, window)
                    hits, matches = part.column("hits").to_pylist(), part.column("matches").to_pylist()
                    doc = np.searchsorted(first, place, "right") - 1
                    order = np.lexsort((place, -length, known.item[q], doc))
                    doc, q, place, length = doc[order], q[order], place[order], length[order]
                    edges = np.flatnonzero(np.diff(doc, prepend=-1, append=part.num_rows))
                    for a, b in zip(edges[:-1], edges[1:], strict=True):
                        d = int(doc[a])
                        at = place[a:b] - first[d]
                        old = [(x["start"], x["end"]) for x in hits[d]]
                        new = np.unique(np.stack((at, at + known.window[q[a:b]]), 1), axis=0).tolist()
                        hits[d] = [{"start": x, "end": y} for x, y in merged(old + [tuple(x) for x in new])]
                        best = {x["item_id"]: x for x in matches[d]}
                        lead = np.flatnonzero(np.append(True, known.item[q[a + 1 : b]] != known.item[q[a : b - 1]])) + a
                        for k in lead.tolist():
                            name = known.names[known.item[q[k]]]
                            if name not in best or best[name]["n_words"] < length[k]:
                                start = known.at[np.searchsorted(known.item, known.item[q[k]])]
                                best[name] = {"item_id": name, "item_word": int(known.at[q[k]] - start), "doc_word": int(place[k] - first[d]), "n_words": int(length[k])}
                        matches[d] = [best[x] for x in sorted(best)]
                    columns = [part.column(i) for i in range(len(kept))]
                    kinds = [part.schema.field(n).type for n in ("hits", "matches")]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(np.diff(first), pa.int64()), pa.array(hits, kinds[0]), pa.array(matches, kinds[1])],
                        [*kept, "n_words", "hits", "matches"],
                    )

        out = out.mapInArrow(W.tidy(search), schema)
        rows = next(left, None)
        if rows is not None:
            path = scratch_path(spark, "matched")
            out.write.parquet(path)
            out = spark.read.schema(schema).parquet(path)
            shared.destroy()
            if written:
                release(spark, written)
            written = path
    return out


def digest(found: DataFrame) -> DataFrame:
    """Counts and a hash from the columns of `find_matches`."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    names = F.array_sort(F.transform("matches", lambda x: x["item_id"]))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("matches").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` without any window of an item, with the columns of `docs`."""
    rows, other = set_aside(docs, ("n_words", "hits", "matches"))
    return put_back(find_matches(rows, items, window).filter(F.size("hits") == 0), docs.columns, other)
