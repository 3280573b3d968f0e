"""Personal data: base patterns against a plain scan, and terms that disclose a value."""

import random
import re
import time

import pytest
from brute import SCHEMA, frame

from tidemark.llm import sanitise

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def counts(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute_spans(text):
    found = [
        (m.start(), k, m.end())
        for k, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if counts(kind, m[0])
    ]
    return [tuple(x) for x in sorted(found)]


def spans(rows, base=False):
    return {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans if not base or s.kind < sanitise.TERM] for r in rows.collect()}


ODD = [
    "a@b.c_d@e.f", "x@y", "x@y.z", "@b.c", "a@@b.c", "..%@-.-", "a@b..c", "a@b.c.", "a@b.c@d.e.f", "é a@b.c é", "𝒳𝒳 1.2.3.4 𝒳",
    "1.2.3", "1.2.3.4.5.6.7.8", "1.2.3.4.5", "256.1.1.1", "0255.001.0.00000000000000000000009", "1.1.1.2555", "999.1.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "41111111111111110", "000000000000", "0" * 19, "0" * 20,
    "+49 30 1234567", "+4", "+44", "+44.", "+1 (743) 555-3824.", "++49 30 1234567", "+12345678", "+123456789", "+1234567890123456",
    "+49 4111 1111 1111 1111", "+1.2.3.4 5678901", "4111 1111 1111 1111@x.com", "10.0.0.1@x.org", None, "", " \t\n", "@", "+",
]


def test_base_patterns(spark):
    chance = random.Random(4)
    pieces = ["a", "B", "é", "𝒳", "@", "@", ".", ".", "-", "_", "%", "+", " ", "(", ")", "1", "2", "55", "0", "411111", "\n", "x@y.z", "1.2.3.4"]
    texts = ODD + ["".join(chance.choices(pieces, k=chance.randint(1, 60))) for _ in range(3000)]
    got = spans(sanitise.find(frame(spark, list(enumerate(texts)))), base=True)
    want = {i: brute_spans(t) for i, t in enumerate(texts)}
    assert got == want and sum(map(len, want.values())) > 1000


def disclosed(spark, texts, **options):
    found = sanitise.find(frame(spark, list(enumerate(texts))), **options).collect()
    return {(r.doc_id, s.value): sanitise.KINDS[s.kind] for r in found for s in r.spans if s.kind >= sanitise.TERM}


def test_terms_that_disclose(spark):
    """'wendeln' stands beside one address in three texts and once elsewhere; 'office' beside many."""
    mail = "wanda.w@example.com"
    texts = [f"please write Wendeln at {mail} or the office {w}" for w in ("one", "two", "three")]
    texts += [f"the office of number {i} please write at someone{i}@example.com" for i in range(40)]
    texts += ["Later WENDELN came; wendelnx did not", "or so they say", "or else", "or more", "or it", "or that", "or five", "or six"]
    got = disclosed(spark, texts)
    assert {t for _, t in got} == {"wendeln", "or"}
    assert all(got[i, "wendeln"] == "term" for i in (0, 1, 2, 43))  # 3 of 4 documents: 0.4 bits are left
    assert got[44, "or"] == "general"  # 3 of 10 documents: 1.7 bits are left
    assert disclosed(spark, texts, general_bits=1).keys() == {k for k in got if k[1] == "wendeln"}
    assert disclosed(spark, texts, support=4) == {}


def test_copies_prove_nothing(spark):
    text = "only here stands Ottokar beside otto@example.org"
    assert disclosed(spark, [text] * 50 + ["nothing else"]) == {}
    assert disclosed(spark, [text, text + "!", text + "?"])[0, "ottokar"] == "term"


def test_words_far_from_a_value_do_not_count(spark):
    far = " ".join(f"w{chr(97 + i)}" for i in range(sanitise.NEAR))
    got = disclosed(spark, [f"Quentin {far} q@example.org {far} Ruprecht {i}" for i in range(3)])
    assert {t for _, t in got} & {"quentin", "ruprecht"} == set() and (0, "wa") in got


def test_words_of_an_address_are_no_terms(spark):
    got = disclosed(spark, [f"call +49 30 123456{i % 1}7 zed.zod@example.net now {i}" for i in range(3)] + ["zed example net"])
    assert {t for _, t in got} == {"call", "now"}


def test_redacted_text(spark):
    texts = [f"Write to Ottokar, o@example.org; 1.2.3.4 {i}" for i in range(3)]
    texts += ["Ottokar came", "(4111 1111 1111 1111) é 𝒳", "+1.2.3.4 5678901.", "nothing", "", None]
    got = {r.doc_id: r.text for r in sanitise.sanitise(frame(spark, list(enumerate(texts)))).collect()}
    # every word beside the address discloses it here; of overlapping spans the first gives the label
    assert [got[i] for i in range(9)] == [f"  , [email]; [ip] {i}" for i in range(3)] + [
        " came", "([card]) é 𝒳", "[phone].", "nothing", "", None]
    general = sanitise.sanitise(frame(spark, list(enumerate(texts))), remove_bits=0).collect()
    assert {r.doc_id: r.text for r in general}[3] == "o* came"


def test_odd_rows(spark):
    rows = [(1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c"), (2, None), (None, None), (3, "x" * 100_000), (3, "other")]
    docs = frame(spark, rows)
    for name in ("th", "spans", "found", "term", "kind", "near", "start", "value", "s", "pair"):
        docs = docs.withColumn(name, docs.n_chars)
    got = sorted((str(r.doc_id), len(r.spans)) for r in sanitise.find(docs).collect())
    assert got == [("1", 1), ("1", 1), ("2", 0), ("3", 0), ("3", 0), ("None", 0), ("None", 1)]
    assert sanitise.sanitise(docs).count() == 7
    empty = spark.createDataFrame([], SCHEMA)
    assert sanitise.find(empty).count() == sanitise.sanitise(empty).count() == 0


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" * 200_000, "a@b.c " * 40_000, "a@" * 200_000],
                         ids=["letters", "digits", "dots", "plus", "addresses", "signs"])
def test_long_runs_take_little_time(spark, text):
    start = time.time()
    got = spans(sanitise.find(frame(spark, [(1, text)])))
    assert len(got[1]) == {"a@b.c": 40_000, "1.1.1": 50_000}.get(text[:5], 0) and time.time() - start < 60
