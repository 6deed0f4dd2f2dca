import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bandscope.llm import pii
from bandscope.llm.labelled import LABELLED

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_pattern(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="1234a@.. -+()é\n", max_size=40))
def test_base_spans_are_the_leftmost_matches(text):
    assert sorted(pii.base_spans(text)) == by_pattern(text)


def test_base_spans_of_near_misses():
    card = "4539 5787 6362 1486"
    text = f"a@b a@b.c @x.y a..b@c-d.e.f. 256.1.1.1 1.2.3.4.5 {card}{card} {card}! +1 23 +1 (555) 010-2233. ++44 20 7946 0991 x@y.z@w.v"
    assert sorted(pii.base_spans(text)) == by_pattern(text)
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")


def test_long_runs_are_scanned_once():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "@" * 50_000, "+1" * 50_000, "1 " * 100_000):
        pii.find_batch([text], OWN)


FIELD = pii.train(LABELLED)
OWN = pii.Kinds(FIELD)


def test_training_rows_are_learned():
    for row in LABELLED:
        tokens, tags = pii.parse(row)
        assert pii.viterbi(FIELD, [FIELD.scores(tokens)])[0].tolist() == tags


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(0)
    k = len(pii.TAGS)
    barred, first = pii.allowed()
    field = pii.Field({}, np.zeros((0, k)), rng.standard_normal((k, k)) + barred, rng.standard_normal(k) + first)
    scores = [rng.standard_normal((n, k)) * 2 for n in (1, 3, 2, 3)]

    def best(s):
        paths = [((t,), field.initial[t] + s[0, t]) for t in range(k)]
        for row in s[1:]:
            paths = [((*p, t), v + field.transition[p[-1], t] + row[t]) for p, v in paths for t in range(k)]
        return max(paths, key=lambda x: x[1])[0]

    assert [tuple(t) for t in pii.viterbi(field, scores, at_once=2)] == [best(s) for s in scores]


def test_spans_beyond_the_patterns_and_clean_text():
    texts = ["call (555) 010-4411 today", "is +1 (578) 555-6437 4918187128635271 eredth", "version 2.0 of 1999, page 12 of 300", "plain words only"]
    found = pii.find_batch(texts, OWN)
    assert [(texts[0][a:b], k, p) for a, b, k, p in found[0]] == [("(555) 010-4411", "phone", False)]
    assert {k for _, _, k, p in found[1] if not p} == {"phone", "card"}
    assert found[2] == [] and found[3] == []


def test_cue_words_and_digits_of_any_script_open_sequences(spark):
    spelled = [f"{cue} [[email {name} at {host} dot {end}]] for more" for cue, name, host, end in (("write", "jane", "example", "com"), ("ask", "rose", "mailer", "org"), ("mail", "tom", "post", "net"))]
    field = pii.train([*LABELLED, *spelled, "they met at noon near the river", "put a dot here and go on"])
    text = "Please ask nina at letters dot org for more."
    assert [(text[a:b], k, p) for a, b, k, p in pii.find_batch([text], pii.Kinds(field))[0]] == [("nina at letters dot org", "email", False)]
    arabic = "call (555) 010-4411 today".translate({0x30 + i: 0x660 + i for i in range(10)})
    docs = spark.createDataFrame([(1, arabic), (2, "plain words only"), (3, None)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.redact(docs).collect()} == {1: "call <PHONE> today", 2: "plain words only", 3: None}


def whole(text, field=FIELD):
    """Spans with every token decoded, by the plain way."""
    tokens = pii.TOKEN.findall(text)
    tags = pii.viterbi(field, [field.scores(tokens)])[0] if tokens else np.zeros(0, int)
    base = pii.base_spans(text)
    spans = [(a, b, k, True) for a, b, k in base] + [(a, b, k, False) for a, b, k in pii.added_spans(text, tags, base)]
    return sorted(spans, key=lambda s: (s[0], pii.KINDS.index(s[2]), s[1]))


@settings(max_examples=300, deadline=None)
@given(st.text(min_size=1, max_size=12))
def test_kinds_have_the_features_of_their_tokens(token):
    for t in pii.TOKEN.findall(token):
        kind = OWN.of([t])[0]
        assert OWN.number(pii.token_features(t)) == kind


def test_shortened_runs_are_decoded_like_whole_ones(spark, sf):
    assert OWN.settled is not None
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert pii.find_batch(texts, OWN) == [whole(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["at", "dot", "call", "0171", "2345678", "x@y", "tel", "10.1.2.3", "(555)", "-", "bob"]), st.integers(0, 40)), max_size=8))
def test_shortened_runs_beside_marks(parts):
    text = " ".join(f"{word} " + "plain " * n for word, n in parts)
    assert pii.find_batch([text], OWN)[0] == whole(text)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6))
def test_settling_of_any_field(seed):
    """Whatever the weights: where runs are said to settle, they do."""
    rng = np.random.default_rng(seed)
    k = len(pii.TAGS)
    barred, _ = pii.allowed()
    field = pii.Field({}, np.zeros((0, k)), rng.standard_normal((k, k)) + barred, np.zeros(k))
    score = rng.standard_normal(k) + np.array([2.5, *[0] * (k - 1)])
    r = pii.settling(field, score)
    if r is not None:
        step = field.transition + score
        ways = [step]
        for _ in range(90):
            ways.append((ways[-1][:, :, None] + step[None]).max(1))
        live = ways[r] > -5e3
        for n in range(r, 90):
            assert np.abs(ways[n] - ways[r - 1] - step[0, 0] * (n - r + 1))[live].max() < 1e-6


def test_spelled_out_and_national_forms():
    """Sentences of another make than the labelled ones."""
    cases = [
        ("Am besten ist sie unter 030 901820 zu sprechen", "030 901820"),
        ("meine Nummer im Büro lautet 0171 2345678 wie immer", "0171 2345678"),
        ("for tickets ask jane at example dot com today", "jane at example dot com"),
        ("as far as I know bob [at] mail [dot] org runs the list", "bob [at] mail [dot] org"),
        ("the editor, rita at library dot edu, will answer", "rita at library dot edu"),
        ("Ruf doch an unter 0711 4455660.", "0711 4455660"),
        ("pour réserver appelez le 01 44 55 66 77 demain", "01 44 55 66 77"),
        ("text my mobile 0772 0900123 if late", "0772 0900123"),
        ("para citas llame al 932 118 450 hoy", "932 118 450"),
    ]
    found = [[t[a:b] for a, b, _, base in spans if not base] for (t, _), spans in zip(cases, pii.find_batch([t for t, _ in cases], OWN))]
    assert sum([want] == got for (_, want), got in zip(cases, found)) >= 8, found
    clean = [
        "at noon we sat at the river and looked at the boats", "the dot at the end of a sentence is called a period",
        "unter anderem kamen 30 Gäste aus 12 Orten", "he wrote 3 books in 1987 and 1988, each of 200 pages",
        "call it what you like, the phone rang 12 times at 7", "the match ended 3-1 after 120 minutes", "bus 42 leaves at 10:15 from stop 9",
        "write 100 lines, then mail them at leisure", "in 2020 about 1,500,000 people lived there", "chapter 3, verse 16 and page 1024",
    ]
    assert [pii.find_batch([t], OWN)[0] for t in clean] == [[]] * len(clean)


def test_features_see_the_whole_token():
    long = "\u6f22" * 80
    assert pii.token_features(f"{long}12@x")[2:4] == ("n=2", "c=TrueFalse")
    assert pii.token_features(f"{long}12@x")[0] == "s=a<2>@a"
    assert pii.token_features("1" * 70)[0] == "s=<16>"


def test_held_out_rows():
    """Made rows of the same kinds: most spans found, clean rows left alone."""
    rng = random.Random(9)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("aeiounrst") for _ in range(rng.randint(2, 8)))
    hit = total = wrong = 0
    for _ in range(200):
        span = rng.choice([f"({d(3)}) 555-{d(4)}", f"4{d(15)}", f"{word()}.{d(2)}@mail{d(1)}.example.com", f"{rng.randint(1, 255)}.{d(2)}.1{d(2)}.{d(1)}"])
        text = f"{word()} {word()} {span} {word()} {word()}"
        spans = pii.find_batch([text], OWN)[0]
        total += 1
        hit += any(text[a:b].strip(".") == span for a, b, _, _ in spans)
        clean = f"{word()} {rng.choice([d(1), d(2), d(4), d(1) + '.' + d(1), d(2) + ',' + d(3)])} {word()} {word()}, {word()}"
        wrong += bool(pii.find_batch([clean], OWN)[0])
    assert hit >= 0.95 * total and wrong <= 0.02 * total


def test_columns_digest_and_redaction(spark):
    text = "mail é@ x.y@example.org or 10.0.0.1, card 4539578763621486"
    rows = [(1, text, "old"), (2, None, "old"), (3, "", None), (3, text, "old"), (None, "no 12 data", "old")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(pii.digest(pii.find_pii(docs)).collect(), key=str)
    one = next(r for r in got if r.doc_id == 1)
    base = ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(by_pattern(text), key=lambda s: (s[0], pii.KINDS.index(s[2]))))
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (1, 1, 1, 0)
    assert one.spans == base and one.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert sum(r.spans == "" for r in got) == 3 and len(got) == 5
    redacted = {(r.doc_id, r.text) for r in pii.redact(docs).collect()}
    assert pii.redact(docs).columns == docs.columns and pii.redact(docs).first().spans == "old"
    cleaned = "mail é@ <EMAIL> or <IP>, card <CARD>"
    assert redacted == {(1, cleaned), (2, None), (3, ""), (3, cleaned), (None, "no 12 data")}
    assert pii.find_pii(docs.limit(0)).count() == 0
