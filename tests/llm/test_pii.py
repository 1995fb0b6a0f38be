import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from steward.llm.bindings import QUERIES
from steward.llm.pii import (
    CONFIDENCE, DISCLOSED, LIKELY, WINDOW, base_spans, candidate_pairs, free_words, luhn, masked, mentions, personal_data,
    revealing_terms, sanitised,
)
from tests.llm.rows import DOCS, documents, prose

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def check_digit(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute(text):
    only = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(only(m[0])) <= 19 and check_digit(only(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(only(m[0])) <= 15]


@pytest.mark.parametrize("seed", range(6))
def test_patterns_are_those_of_the_plain_expressions(seed):
    rng = random.Random(seed)
    signs = ["aZ.@-+ ()0123456789%é\n", "0123456789 -.+@a", "a.@"][seed % 3]
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))
        assert base_spans(text) == brute(text), text


def test_long_runs_take_no_longer():
    for run in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "+1 " * 100_000, "a@" * 150_000):
        base_spans(run)
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def people(spark):
    """Everybody writes to one address; Zorbane does so always, and nobody else is called so."""
    rows = [(i, f"{prose(i, 40)} Zorbane wrote{i} to boss@corp.example.com about the plan number{i} {prose(500 + i, 30)}", "en", "a") for i in range(8)]
    rows += [(100 + i, f"the plan about to {prose(900 + i, 60)}", "en", "a") for i in range(60)]
    return documents(spark, rows)


def test_terms_that_reveal_an_entity(spark):
    found = {r["doc_id"]: r for r in personal_data(people(spark)).collect()}
    texts = {r["doc_id"]: r["text"] for r in people(spark).collect()}
    for i in range(8):
        spans = {texts[i][s["start"] : s["end"]] for s in found[i]["terms"]}
        assert "Zorbane" in spans and not spans & {"the", "plan", "to", "about", f"wrote{i}"}
    assert all(found[100 + i]["terms"] is None and found[100 + i]["n_email"] == 0 for i in range(60))


def test_masks(spark):
    clean = {r["doc_id"]: r["text"] for r in sanitised(people(spark)).collect()}
    assert all("[EMAIL]" in clean[i] and "[TERM]" in clean[i] and "Zorbane" not in clean[i] and "corp" not in clean[i] for i in range(8))
    removed = {r["doc_id"]: r["text"] for r in sanitised(people(spark), action="remove").collect()}
    assert "[TERM]" not in removed[0] and "Zorbane" not in removed[0]
    assert masked("a +1 555 123 4567 b", [], "generalise") == "a [PHONE] b" and masked(None, [], "remove") is None
    with pytest.raises(ValueError):
        sanitised(people(spark), action="hide")


def test_copies_are_one_context(spark):
    rows = [(i, "Zorbane wrote to boss@corp.example.com about it", "en", "a") for i in range(30)]
    rows += [(100 + i, prose(i, 50), "en", "a") for i in range(30)]
    assert personal_data(documents(spark, rows)).filter("terms IS NOT NULL").count() == 0


def revealed(spark, rows):
    """The words of ``rows(doc_id, text)`` that are spans, in small letters."""
    found = personal_data(documents(spark, [(i, t, "en", "a") for i, t in rows])).filter("terms IS NOT NULL").collect()
    texts = dict(rows)
    return {texts[r["doc_id"]][s["start"] : s["end"]].lower() for r in found for s in r["terms"]}


@pytest.mark.parametrize("n", [1000, 1100, 3000])
def test_what_was_seen_once_is_no_evidence_in_a_table_of_any_size(spark, n):
    rows = [(0, "write zorbane quickly jo@corp.example.com about plan")] + [(i, prose(i, 40)) for i in range(1, n)]
    assert revealed(spark, rows) == set()


@pytest.mark.parametrize("n", [300, 1000, 1100])
def test_addresses_of_one_domain_are_pooled(spark, n):
    rows = [(i, f"{prose(i, 20)} zorbane a{i}@corp.example.com {prose(50 + i, 20)}") for i in range(4)]
    rows += [(i, prose(i, 40)) for i in range(10, n)]
    assert revealed(spark, rows) == {"zorbane"}


def planted(seed, n=1500):
    """People who are named beside their own address in three to six documents, and rare words beside other addresses: one or two
    documents each, or as often without the address as with it."""
    rng = random.Random(seed)
    rows, names, rare = [], set(), set()
    for p in range(30):
        names.add(f"qname{p}x")
        rows += [f"{prose(rng.random(), 15)} qname{p}x wrote user{p}@host{p}.example.com {prose(rng.random(), 15)}" for _ in range(rng.randint(3, 6))]
    for p in range(200):
        rare.add(f"zrare{p}y")
        rows += [f"{prose(rng.random(), 15)} zrare{p}y one{p}@other{p}.example.com {prose(rng.random(), 15)}" for _ in range(rng.randint(1, 2))]
    for p in range(30):
        rare.add(f"ycommon{p}z")
        texts = (f"{prose(rng.random(), 15)} ycommon{p}z {'many%d@more%d.example.com' % (p, p) if i % 2 else ''} {prose(rng.random(), 15)}" for i in range(10))
        rows += texts
    rows += [prose(rng.random(), 30) for _ in range(n - len(rows))]
    return list(enumerate(rows)), names, rare


def test_precision_and_recall_on_planted_names(spark):
    rows, names, rare = planted(5)
    spans = revealed(spark, rows)
    assert names <= spans and not spans & rare
    assert len(spans & names) / len(spans) > 0.9


def brute_terms(rows):
    """The judgement pair by pair, in plain loops."""
    z2, n = CONFIDENCE**2, len(rows)
    words = {i: {w.lower() for w in re.findall(r"[^\W\d_][\w'-]*", t)} for i, t in rows}
    free = {i: {w for _, _, w in free_words(t, base_spans(t))} for i, t in rows}
    contexts, holders = {}, {}
    for i, t in rows:
        for span in base_spans(t):
            mine = [w for w in free_words(t, base_spans(t))]
            before = [w for a, _, w in mine if a < span[1]][-WINDOW:]
            around = before + [w for a, _, w in mine if a >= span[2]][:WINDOW]
            value = t[span[1] : span[2]].lower()
            for entity in {(span[0], value), *([("domain", value.split("@")[1])] if span[0] == "email" else [])}:
                holders.setdefault(entity, set()).add(i)
                for w in around:
                    contexts.setdefault((entity, w), set()).add(tuple(around))
    out = {}
    for (entity, w), seen in contexts.items():
        n_e, n_t = len(holders[entity]), sum(w in words[i] for i, _ in rows)
        n_et, k = sum(w in free[i] for i in holders[entity]), len(seen)
        rate, own = n_et / n_t, n_e / n
        m = k / rate
        low = (rate + z2 / 2 / m - CONFIDENCE * (rate * (1 - rate) / m + z2 / 4 / m / m) ** 0.5) / (1 + z2 / m)
        given = 1 - math.log((rate * k + own) / (k + 1)) / math.log(own)
        if given >= DISCLOSED and low > LIKELY:
            out[w] = max(out.get(w, 0), given)
    return out


def test_disclosure_equals_brute_force(spark):
    rng = random.Random(8)
    common = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = []
    for i in range(400):
        said = [rng.choice(common) for _ in range(12)]
        if i % 3 == 0:
            p = rng.randrange(12)
            said.insert(rng.randrange(12), f"u{p}@d{p % 5}.example.com")
            if rng.random() < 0.8:
                said.insert(rng.randrange(12), f"name{'abcdefghijkl'[p]}")
        elif rng.random() < 0.1:
            said.append(f"name{rng.choice('abcdefghijkl')}")
        rows.append((i, " ".join(said)))
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows]).select("doc_id", "text")
    judged = revealing_terms(docs, mentions(docs))[0].groupBy("term").agg(F.max("disclosure").alias("d")).collect()
    want = brute_terms(rows)
    assert want and {r["term"] for r in judged} == want.keys()
    assert all(math.isclose(r["d"], want[r["term"]]) for r in judged)


def test_pruning_before_counting_loses_nothing(spark):
    """Every pair judged without pruning that reveals is among the candidates; pairs seen once or twice are not counted."""
    rows, names, rare = planted(6, 900)
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows]).select("doc_id", "text")
    found = mentions(docs)
    kept = {r["term"] for r in candidate_pairs(found).select("term").distinct().collect()}
    assert brute_terms(rows).keys() <= kept and names <= kept and not kept & {w for w in rare if w.startswith("zrare")}


def test_revealing_terms_are_spans_wherever_they_stand(spark):
    far = prose(700, 30) + " zorbane\n" + prose(701, 30)
    rows = [(r["doc_id"], r["text"] + far, "en", "a") for r in people(spark).filter("doc_id < 8").collect()]
    # Two more texts hold the name without the address, and one the address with the name far from it.
    rows += [(8, prose(800, 30) + " Zorbane, again", "en", "a"), (9, f"Zorbane {prose(801, 40)} boss@corp.example.com", "en", "a")]
    rows += [(100 + i, f"the plan about to {prose(900 + i, 60)}", "en", "a") for i in range(3000)]
    texts = {r[0]: r[1] for r in rows}
    found = {r["doc_id"]: r["terms"] for r in personal_data(documents(spark, rows)).filter("terms IS NOT NULL").collect()}
    for i in range(10):
        want = [m.span() for m in re.finditer("[Zz]orbane", texts[i])]
        assert len(want) == (2 if i < 8 else 1) and set(want) <= {(s["start"], s["end"]) for s in found[i]}
    clean = {r["doc_id"]: r["text"] for r in sanitised(documents(spark, rows)).filter("doc_id < 10").collect()}
    assert not any("zorbane" in t.lower() for t in clean.values())


def test_odd_rows_and_columns(spark, odd_documents):
    found = personal_data(odd_documents).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["base_spans"]) for r in found) == sorted(
        (d is not None, d or 0, ",".join(f"{k}:{a}:{b}" for k, a, b in brute(t or ""))) for d, t, _, _ in DOCS
    )
    clean = sanitised(odd_documents)
    assert clean.columns == odd_documents.columns and clean.count() == len(DOCS)
    texts = {r["doc_id"]: r["text"] for r in clean.select("doc_id", "text").collect()}
    assert texts[5] is None and texts[6] == "" and texts[11] == "mail me at [EMAIL] or [PHONE] now" and texts[12] == DOCS[13][1]
    assert personal_data(documents(spark, [])).count() == 0 and sanitised(documents(spark, [])).count() == 0


def test_query_columns(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op8_pii"](spark, sf).collect():
        spans = brute(texts[r["doc_id"]] or "")
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        assert r["spans"] == base or r["spans"].startswith(base)
