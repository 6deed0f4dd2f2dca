"""Fill-in-middle: documents re-ordered as prefix, suffix, middle, assembled by a secondary sort.

A text is cut at two units (a run of ASCII letters, or any other character) that follow from a hash of its
doc_id. It leaves its task as pieces of whole units, keyed by the document and by their place in the
output; the markers are pieces too. Pieces are repartitioned by document and sorted within the partitions,
so a task reads each document's pieces in output order and feeds them to one running digest (or joins
them to the output text). For restoration the same pieces are sorted anew within their partitions, by the
place that the markers before them and the form tell, and run through a second digest.

No task holds more than one piece of a document, and Spark's sort spills what does not fit. This is the
repartitionAndSortWithinPartitions of RDDs, in the form DataFrames have for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandscope.llm import words as W

# Markers of the three parts.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
SEED = 1
# Per cent of documents that are re-ordered, and of those the share that begins with the suffix.
REORDERED, SUFFIX_FIRST = 90, 20
# Units in a piece, and bytes in a piece whatever its units.
UNITS, PIECE_BYTES = 8192, 1 << 16
# Bytes of text that one task sorts, about.
TASK_BYTES = 64 << 20

ROW = "h long, part int, row long"
FACTS = "doc_id {kind}, n long, form string, prefix_chars long, middle_chars long"
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def draws(doc_id: object, seed: int) -> tuple[int, int, int, int]:
    """Four numbers below 2 ** 32 from the hash of seed:doc_id; a null doc_id counts as empty."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(h[k : k + 4], "big") for k in (0, 4, 8, 12))


def unit_starts(col: W.Column) -> tuple[np.ndarray, np.ndarray]:
    """Where units begin in the bytes of a slice, and each row's first unit (rows + 1 entries)."""
    letter = LETTERS[col.data]
    begins = (col.data & 0xC0) != 0x80
    joined = letter[1:] & letter[:-1]
    edge = col.offsets[(col.offsets > 0) & (col.offsets < len(col.data))]
    joined[edge - 1] = False
    begins[1:] &= ~joined
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, col.offsets)


def form_of(text: bytes, n: int, h: tuple[int, int, int, int], reordered: int, suffix_first: int) -> str:
    if not n or any(m in text for m in MARKERS) or h[2] % 100 >= reordered:
        return "plain"
    return "spm" if h[3] % 100 < suffix_first else "psm"


def chunks(data: bytes, bounds: np.ndarray, a: int, b: int) -> Iterator[bytes]:
    """Units a to b in pieces of UNITS units or fewer, and of PIECE_BYTES or fewer."""
    for at in range(a, b, UNITS):
        some = data[bounds[at] : bounds[min(at + UNITS, b)]]
        for k in range(0, len(some), PIECE_BYTES):
            yield some[k : k + PIECE_BYTES]


def pieces(
    docs: DataFrame,
    seed: int = SEED,
    reordered: int = REORDERED,
    suffix_first: int = SUFFIX_FIRST,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """The pieces of all outputs, each document's in output order within one partition.

    docs has doc_id (any simple type) and text. A row is known by a hash of its contents, its partition and
    its place there, so repeated rows stay apart, and a task that is run again sends them to the same
    place. The first piece (at -1) of each row holds no bytes but its facts: doc_id, n units, form, and the
    code points of prefix and middle (null if plain). Null texts count as empty.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    facts = FACTS.format(kind=kind)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in W.slices(batch, "text"):
                col = W.column(part.column("text"))
                starts, first = unit_starts(col)
                chars = np.append(0, np.cumsum((col.data & 0xC0) != 0x80))
                out = []
                names, hashes = part.column("doc_id").to_pylist(), part.column("h").to_pylist()
                for k, (doc_id, h) in enumerate(zip(names, hashes, strict=True)):
                    data = col.data[col.offsets[k] : col.offsets[k + 1]].tobytes()
                    n = int(first[k + 1] - first[k])
                    bounds = np.append(starts[first[k] : first[k + 1]] - col.offsets[k], len(data))
                    drawn = draws(doc_id, seed)
                    form = form_of(data, n, drawn, reordered, suffix_first)
                    a, b = sorted((drawn[0] % (n + 1), drawn[1] % (n + 1)))
                    places = chars[col.offsets[k] + bounds[[0, a, b]]] if form != "plain" else None
                    sizes = (int(places[1] - places[0]), int(places[2] - places[1])) if form != "plain" else (None, None)
                    key = (h, task, row)
                    row += 1
                    out.append((*key, -1, None, doc_id, n, form, *sizes))
                    parts = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, n)}
                    order = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE), "plain": ()}[form]
                    at = 0
                    for marker in order or (b"",):
                        if marker:
                            out.append((*key, at, marker, None, None, None, None, None))
                            at += 1
                        for some in chunks(data, bounds, *parts.get(marker, (0, n))):
                            out.append((*key, at, some, None, None, None, None, None))
                            at += 1
                    if len(out) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names_out)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names_out)

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), id_type, pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names_out = ["h", "part", "row", "at", "piece", "doc_id", "n", "form", "prefix_chars", "middle_chars"]
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keyed = docs.withColumn("h", F.xxhash64("doc_id", "text"))
    cut = keyed.mapInArrow(W.tidy(emit), f"{ROW}, at long, piece binary, {facts}")
    return cut.repartition(max(1, -(-total // task_bytes)), "h").sortWithinPartitions("h", "part", "row", "at")


class Rows:
    """Batches of output rows of the given schema."""

    def __init__(self, names: list[str], types: list[pa.DataType], size: int = 1024):
        self.names, self.types, self.size, self.rows, self.bytes = names, types, size, [], 0

    def add(self, row: tuple, weight: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += weight
        if len(self.rows) >= self.size or self.bytes >= W.SLICE_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(x, t) for x, t in zip(zip(*self.rows, strict=True), self.types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, self.names)
            self.rows, self.bytes = [], 0


def piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, at, piece, facts) of sorted pieces, a few MB of them as Python objects at a time."""
    for batch in batches:
        for some in W.slices(batch, "piece"):
            c = {n: some.column(n).to_pylist() for n in some.schema.names}
            facts = zip(c["doc_id"], c["n"], c["form"], c["prefix_chars"], c["middle_chars"], strict=True)
            yield from zip(zip(c["h"], c["part"], c["row"], strict=True), c["at"], c["piece"], facts, strict=True)


def digests(sorted_pieces: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256 of every row.

    The first pass reads pieces in output order. It takes nothing but the bytes and the form: a marker tells which
    part follows, and by it every piece gets its place in the text restored. The second pass reads them by
    that place.
    """
    fields = sorted_pieces.schema
    kind = fields["doc_id"].dataType.simpleString()
    schema = f"{ROW}, at long, piece binary, {FACTS.format(kind=kind)}, output_sha256 string"

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(fields["doc_id"].dataType)
    fact_types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.int64()]
    fact_names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    key_names, key_types = ["h", "part", "row", "at", "piece"], [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows([*key_names, *fact_names, "output_sha256"], [*key_types, *fact_types, pa.string()])
        digest, facts, key, section = hashlib.sha256(), None, None, 0
        for own, at, piece, told in piece_rows(batches):
            if at < 0:
                if key is not None:
                    yield from out.add((*key, -1, None, *facts, digest.hexdigest()))
                key, facts, digest, section = own, told, hashlib.sha256(), 0
                continue
            digest.update(piece)
            if facts[2] != "plain" and piece in MARKERS:
                section = (PREFIX, MIDDLE, SUFFIX).index(piece)
                continue
            # Places of later parts lie beyond any number of pieces of earlier ones.
            yield from out.add((*own, (section << 48) + at, piece, *[None] * 6), len(piece))
        if key is not None:
            yield from out.add((*key, -1, None, *facts, digest.hexdigest()))
        yield from out.flush()

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows([*fact_names, "output_sha256", "restored_sha256"], [*fact_types, pa.string(), pa.string()])
        digest, facts = None, None
        for batch in batches:
            for some in W.slices(batch, "piece"):
                c = [some.column(n).to_pylist() for n in ("at", "piece", *fact_names, "output_sha256")]
                for at, piece, *told in zip(*c, strict=True):
                    if at < 0:
                        if facts is not None:
                            yield from out.add((*facts, digest.hexdigest()))
                        facts, digest = told, hashlib.sha256()
                    else:
                        digest.update(piece)
        if facts is not None:
            yield from out.add((*facts, digest.hexdigest()))
        yield from out.flush()

    return (
        sorted_pieces.mapInArrow(W.tidy(assemble), schema)
        .sortWithinPartitions("h", "part", "row", "at")
        .mapInArrow(W.tidy(restore), f"{FACTS.format(kind=kind)}, output_sha256 string, restored_sha256 string")
    )


def transform(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output `text` of every row of docs (doc_id, text).

    Rows stand on their own: null texts count as empty, repeated rows come back as often, other columns are left
    out, an empty table gives an empty one.
    """
    cut = pieces(docs, **options)
    kind = cut.schema["doc_id"].dataType.simpleString()

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(cut.schema["doc_id"].dataType), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(["doc_id", "n", "form", "prefix_chars", "middle_chars", "text"], types)
        facts, held = None, []
        for _, at, piece, told in piece_rows(batches):
            if at < 0:
                if facts is not None:
                    yield from out.add((*facts, b"".join(held).decode()), sum(map(len, held)))
                facts, held = told, []
            else:
                held.append(piece)
        if facts is not None:
            yield from out.add((*facts, b"".join(held).decode()))
        yield from out.flush()

    return cut.mapInArrow(W.tidy(assemble), f"{FACTS.format(kind=kind)}, text string")


def restored(rows: DataFrame) -> DataFrame:
    """doc_id and the text that was transformed, from `form` and the output `text` alone. Built-in functions only."""
    parts = r"(?s)^<{}>(.*)<{}>(.*)<{}>(.*)$"
    piece = lambda form, k: F.regexp_extract("text", parts.format(*form), k)
    psm, spm = [piece("PSM", k) for k in (1, 3, 2)], [piece("SPM", k) for k in (2, 3, 1)]
    text = F.when(F.col("form") == "psm", F.concat(*psm)).when(F.col("form") == "spm", F.concat(*spm))
    return rows.select("doc_id", text.otherwise(F.col("text")).alias("text"))
