"""Personal data: fixed patterns, and a linear-chain conditional random field that adds spans.

The field labels every token (run without white space) of the whole text. Features are shapes of the token and its neighbours and a
few cue words, so tokens fall into a few hundred kinds, and most are plain words among plain words. It is
trained on a small labelled table (`labelled.LABELLED` unless another is given) and decoded by Viterbi in
numpy, many texts at a time. Long runs of plain words are decoded as shorter ones: a fitted field tells from which length on
one word more changes nothing but adds a word outside of spans (`settling`), which is checked and not assumed.
Every document is handled alone: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandscope.llm import words as W
from bandscope.llm.columns import put_back, set_aside
from bandscope.llm.labelled import LABELLED

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
CUES = frozenset(
    "email mail e-mail write phone call tel fax mobile card visa number ip host server address at dot"
    " telefon handy unter rufen schreiben karte téléphone appelez écrivez teléfono llame tarjeta".split()
)

# Lookbehinds keep the scan linear in long runs of digits: a match that fails at the start of a run fails inside it too.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"[^ \t\n\r\f\v]+")
# A plain word; runs of them are tried for shortening up to LONGEST_RUN. Tokens a worker remembers; cells of one Viterbi table.
PLAIN, LONGEST_RUN = "word", 64
REMEMBERED, CELLS = 1 << 18, 1 << 18
DIGIT = re.compile(r"[0-9]")
NUMERAL = re.compile(r"\d")
EDGES = ".,;:!?()[]<>\"'"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost matches, found from their at signs: a match has one, just before its domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        # What stands between two at signs need not be looked at twice.
        done = domain.end() if domain else at + 1
        if domain:
            yield begin, done
        at = text.find("@", done)


def octets(found: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found.split("."))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost matches of each kind that do not overlap, less those that fail its test, in code points."""
    out = [(a, b, "email") for a, b in emails(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if octets(m[0])]
    for kind, pattern, low, high in (("card", CARD, 14, 19), ("phone", PHONE, 10, 15)):
        for m in pattern.finditer(text):
            digits = "".join(DIGIT.findall(m[0]))
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                out.append((m.start(), m.end(), kind))
    return out


# -- conditional random field


def token_features(token: str) -> tuple[str, ...]:
    """Shape features of one token, all of it; runs of letters and of digits are shortened. Long tokens are not kept."""
    return short_token_features(token) if len(token) <= 64 else whole_token_features(token)


def whole_token_features(token: str) -> tuple[str, ...]:
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"\d+", lambda m: f"<{min(len(m[0]), 5) if len(m[0]) < 14 else 16}>", token))
    core = token.lower().strip(EDGES)
    loose = re.sub(r"<\d+>", "9", shape.strip(".,;:!?"))
    digits = len(NUMERAL.findall(token))
    out = [f"s={shape.strip('.,;:!?')}", f"l={loose}", f"n={min(digits, 5) if digits < 14 else 16}", f"c={'@' in token}{token[:1] in '+('}"]
    if core in CUES:
        out.append(f"w={core}")
    return tuple(out)


short_token_features = lru_cache(maxsize=1 << 14)(whole_token_features)


def sequence_features(tokens: list[str]) -> list[list[str]]:
    own = [token_features(t) for t in tokens]
    edge = ("edge",)
    return [
        [f"0{f}" for f in own[i]]
        + [f"-{f}" for f in (own[i - 1] if i else edge)]
        + [f"+{f}" for f in (own[i + 1] if i + 1 < len(own) else edge)]
        for i in range(len(own))
    ]


@dataclass
class Field:
    """Rows of `emission` by feature, scores of one tag after another (row before column), and of the first tag."""

    index: dict[str, int]
    emission: np.ndarray
    transition: np.ndarray
    initial: np.ndarray

    def share(self, features: tuple[str, ...], place: str) -> np.ndarray:
        """What a token of these features adds to the scores of itself (0), of the one after (-) or before (+) it."""
        rows = [self.index[place + f] for f in features if place + f in self.index]
        return self.emission[rows].sum(0)

    def scores(self, sequence: list[str]) -> np.ndarray:
        out = np.zeros((len(sequence), len(TAGS)))
        for i, found in enumerate(sequence_features(sequence)):
            rows = [self.index[f] for f in found if f in self.index]
            out[i] = self.emission[rows].sum(0)
        return out


class Kinds:
    """Tokens by kind, those of equal features, and the scores of whole texts from the kinds of their tokens."""

    def __init__(self, field: Field):
        self.field = field
        self.known: dict[str, int] = {}
        self.numbers: dict[tuple[str, ...], int] = {}
        # Row 0 stands for the edge of a text.
        self.shares = {place: [field.share(("edge",), place)] for place in "0-+"}
        self.tables = [np.zeros((0, len(TAGS)))] * 3
        self.plain = self.number(token_features(PLAIN))
        self.settled = settling(field, self.scores(np.full(3, self.plain))[1])

    def number(self, features: tuple[str, ...]) -> int:
        if features not in self.numbers:
            self.numbers[features] = len(self.shares["0"])
            for place, rows in self.shares.items():
                rows.append(self.field.share(features, place))
        return self.numbers[features]

    def of(self, tokens: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        for token in set(tokens).difference(self.known):
            core = token.strip(".,;:!?")
            # Letters with stops around them have the features of any word, unless they are a cue.
            word = core.isalpha() and core.lower() not in CUES
            self.known[token] = self.plain if word else self.number(token_features(token))
        return np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))

    def scores(self, kinds: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Scores of the tokens at some places of a text."""
        before, after = np.append(0, kinds[:-1]), np.append(kinds[1:], 0)
        if len(self.tables[0]) < len(self.shares["0"]):
            self.tables = [np.array(self.shares[place]) for place in "0-+"]
        own, earlier, later = self.tables
        return own[kinds[at]] + earlier[before[at]] + later[after[at]]

    def needed(self, kinds: np.ndarray) -> np.ndarray:
        """Places of the tokens to decode: all but the middle of long runs of plain words among plain words."""
        if self.settled is None:
            return np.arange(len(kinds))
        plain = np.concatenate(([False], kinds == self.plain, [False]))
        same = np.concatenate(([False], plain[:-2] & plain[1:-1] & plain[2:], [False])).astype(np.int8)
        turns = np.flatnonzero(np.diff(same))
        keep = np.ones(len(kinds), bool)
        half = self.settled // 2
        for begin, end in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            if end - begin > self.settled:
                keep[begin + half : end - (self.settled - half)] = False
        return np.flatnonzero(keep)


def settling(field: Field, score: np.ndarray) -> int | None:
    """The length from which on a run of tokens of this score is like one of one token less, with a token outside more.

    M ** r in (max, +) holds the best ways through r such tokens. If M ** (r + 1) = M ** r + the score of staying
    outside, it is so for all lengths beyond, by multiplying with M again; and if each best way of r steps is outside in its
    middle, a further token may be put in there. None if there is no such r up to LONGEST_RUN.
    """
    step = field.transition + score[None, :]
    stay = step[0, 0]
    ways, mids = step, [step]
    for r in range(1, LONGEST_RUN):
        after = (ways[:, :, None] + step[None]).max(1)
        live = after > -5e3
        if r >= 4 and np.abs(after - ways - stay)[live].max(initial=0.0) < 1e-9 and (ways[live] > -5e3).all():
            # The best ways through O after half of the steps, against all ways.
            half = r // 2
            through = mids[half - 1][:, :1] + mids[r - half - 1][:1]
            if (np.abs(through - ways)[ways > -5e3] < 1e-9).all():
                return r
        ways = after
        mids.append(ways)
    return None


def allowed() -> tuple[np.ndarray, np.ndarray]:
    """Inside tags follow a tag of their own kind only. 0 where allowed, else very low."""
    t = np.zeros((len(TAGS), len(TAGS)))
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            t[:, j] = -1e4
            t[[j - 1, j], j] = 0
    return t, np.array([-1e4 if tag[0] == "I" else 0.0 for tag in TAGS])


def parse(row: str) -> tuple[list[str], list[int]]:
    """Tokens and tags of a labelled row: spans stand in double brackets, their kind first."""
    tokens: list[str] = []
    tags: list[int] = []
    kind, part = "", "I"
    for word in row.split():
        if word.startswith("[["):
            kind, part = word[2:], "B"
            continue
        tokens.append(word.replace("]]", ""))
        tags.append(TAGS.index(f"{part}-{kind}") if kind else 0)
        part = "I"
        if "]]" in word:
            kind = ""
    return tokens, tags


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def train(rows: list[str], steps: int = 250, rate: float = 0.1, l2: float = 0.02) -> Field:
    """Maximum likelihood with an L2 penalty, by Adam over all rows at once. The table is small by contract."""
    parsed = [p for p in map(parse, rows) if p[0]]
    found = [sequence_features(tokens) for tokens, _ in parsed]
    index = {f: k for k, f in enumerate(sorted({f for s in found for t in s for f in t}))}
    n, longest, k = len(parsed), max((len(t) for t, _ in parsed), default=0), len(TAGS)
    x = np.zeros((n, longest, len(index)))
    y = np.zeros((n, longest), int)
    live = np.zeros((n, longest), bool)
    for a, (s, (_, tags)) in enumerate(zip(found, parsed, strict=True)):
        for b, t in enumerate(s):
            x[a, b, [index[f] for f in t]] = 1
            y[a, b], live[a, b] = tags[b], True
    barred, barred_first = allowed()
    params = [np.zeros((len(index), k)), np.zeros((k, k)), np.zeros(k)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    one_hot = np.eye(k)[y] * live[:, :, None]
    pairs = np.einsum("nti,ntj->ij", one_hot[:, :-1], one_hot[:, 1:])
    for step in range(1, steps + 1) if n else ():
        emission, transition, initial = params[0], params[1] + barred, params[2] + barred_first
        e = x @ emission
        ahead, back = np.zeros((n, longest, k)), np.zeros((n, longest, k))
        ahead[:, 0] = initial + e[:, 0]
        for t in range(1, longest):
            new = log_sum(ahead[:, t - 1, :, None] + transition, 1) + e[:, t]
            ahead[:, t] = np.where(live[:, t, None], new, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = log_sum(transition + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(live[:, t + 1, None], new, 0)
        total = log_sum(ahead[:, -1], 1)
        marginal = np.exp(ahead + back - total[:, None, None]) * live[:, :, None]
        both = np.zeros((k, k))
        for t in range(1, longest):
            p = np.exp(ahead[:, t - 1, :, None] + transition + (e[:, t] + back[:, t])[:, None, :] - total[:, None, None])
            both += (p * live[:, t, None, None]).sum(0)
        gradients = [
            np.einsum("ntf,ntk->fk", x, marginal - one_hot) + l2 * params[0],
            both - pairs + l2 * params[1],
            (marginal - one_hot)[:, 0].sum(0) + l2 * params[2],
        ]
        for p, g, (m, v) in zip(params, gradients, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(index, params[0], params[1] + barred, params[2] + barred_first)


def viterbi(field: Field, scores: list[np.ndarray], at_once: int = 256) -> list[np.ndarray]:
    """The best tags of each sequence; sequences of like length are decoded together, in tables of bounded size."""
    out: list[np.ndarray] = [np.zeros(0, int)] * len(scores)
    order = sorted((i for i in range(len(scores)) if len(scores[i])), key=lambda i: len(scores[i]))
    begin = 0
    while begin < len(order):
        end = begin + 1
        while end < min(len(order), begin + at_once) and (end - begin + 1) * len(scores[order[end]]) <= CELLS:
            end += 1
        group = order[begin:end]
        begin = end
        sizes = np.array([len(scores[i]) for i in group])
        longest = int(sizes.max(initial=0))
        e = np.zeros((len(group), longest, len(TAGS)))
        for row, i in enumerate(group):
            e[row, : sizes[row]] = scores[i]
        best = field.initial + e[:, 0]
        came = np.zeros((len(group), longest, len(TAGS)), np.int8)
        for t in range(1, longest):
            paths = best[:, :, None] + field.transition
            came[:, t] = paths.argmax(1)
            best = np.where((t < sizes)[:, None], paths.max(1) + e[:, t], best)
        tag = best.argmax(1)
        tags = np.zeros((len(group), longest), int)
        for t in range(longest - 1, -1, -1):
            tags[:, t] = tag
            step = came[np.arange(len(group)), t, tag]
            tag = np.where((t < sizes) & (t > 0), step, tag)
        for row, i in enumerate(group):
            out[i] = tags[row, : sizes[row]]
    return out


def added_spans(text: str, tags: np.ndarray, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans of the tags of all tokens, without stops and quotes around them, where they meet no base span."""
    out = []
    run = [m.span() for m in TOKEN.finditer(text)]
    at = 0
    for at in np.flatnonzero(tags).tolist():
        if TAGS[tags[at]][0] == "I":
            continue
        end = at + 1
        while end < len(run) and TAGS[tags[end]][0] == "I":
            end += 1
        a, b = run[at][0], run[end - 1][1]
        while b > a and text[b - 1] in ".,;:!?\"'>]":
            b -= 1
        while a < b and text[a] in "\"'<[,;:":
            a += 1
        if a < b and not any(x < b and a < y for x, y, _ in base):
            out.append((a, b, TAGS[tags[at]][2:]))
    return out


def find_batch(texts: list[str], kinds: Kinds) -> list[list[tuple[int, int, str, bool]]]:
    """Spans (start, end, kind, base) of each text, by start, then kind as listed."""
    found = [kinds.of(TOKEN.findall(t)) for t in texts]
    needed = [kinds.needed(f) for f in found]
    decoded = viterbi(kinds.field, [kinds.scores(f, at) for f, at in zip(found, needed, strict=True)])
    out = []
    for text, own, at, part in zip(texts, found, needed, decoded, strict=True):
        known = base_spans(text)
        more = []
        if part.any():
            tags = np.zeros(len(own), int)
            tags[at] = part
            more = added_spans(text, tags, known)
        spans = [(a, b, k, True) for a, b, k in known] + [(a, b, k, False) for a, b, k in more]
        out.append(sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))
    return out


SPAN = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def redacted(text: str, spans: list[tuple[int, int, str, bool]]) -> str:
    """The text with each group of overlapping spans replaced by the kind of its first, in angle brackets."""
    out, done = [], 0
    for a, b, kind, _ in spans:
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def find_pii(docs: DataFrame, rows: list[str] = LABELLED, text: str = "text", redact: bool = False) -> DataFrame:
    """`docs` with a column `spans` (kind, start, end in code points, whether a base pattern found it).

    With `redact` the text has each span replaced by its kind. A column `spans` before is replaced; null
    and empty texts have no spans and stay as they are; repeated rows are handled alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(rows))
    kept = [c for c in docs.columns if c != "spans"]
    base = docs.select(*kept)
    out = base.withColumn("spans", F.expr(f"CAST(array() AS {SPAN})"))
    place = kept.index(text)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = Kinds(shared.value)
        for batch in batches:
            for part in W.slices(batch, text):
                col = W.column(part.column(text))
                some = np.flatnonzero(np.diff(col.offsets))
                texts = [col.text(i) for i in some]
                found = find_batch(texts, kinds)
                spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for i, own in zip(some, found, strict=True):
                    spans[i] = [{"kind": k, "start": a, "end": b, "base": p} for a, b, k, p in own]
                columns = [part.column(i) for i in range(len(kept))]
                if redact:
                    changed = columns[place].to_pylist()
                    for i, t, own in zip(some, texts, found, strict=True):
                        changed[i] = redacted(t, own)
                    columns[place] = pa.array(changed, columns[place].type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, part.schema.field("spans").type)], [*kept, "spans"])

    return out.mapInArrow(W.tidy(search), out.schema)


def redact(docs: DataFrame, rows: list[str] = LABELLED, text: str = "text") -> DataFrame:
    """`docs` with the spans in its texts replaced by their kinds, and all other columns as they were."""
    kept, other = set_aside(docs, ("spans",))
    return put_back(find_pii(kept, rows, text, redact=True), docs.columns, other)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, a hash of them and all spans as text, from the columns of `find_pii`."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
