import re

from hypothesis import given, settings
from hypothesis import strategies as st

from greenlake.llm import pii

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
            ok = (True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 12 <= len(d) <= 19 and luhn, 9 <= len(d) <= 15)[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("a.@-+ ()0123456789é\n"), max_size=80))
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_base_examples():
    text = "é me@x.co 1.2.3.4 or 4111 1111 1111 1111 or +1 (017) 555-7713 or 1.2.3.400 or 4111 1111 1111 1112"
    assert pii.shown(pii.base_spans(text)) == "email:2:9,ip:10:17,card:21:40,phone:44:61"
    # Digits run on over a space: neither the longer card nor the longer phone number passes.
    assert pii.shown(pii.base_spans("1.2.3.4 4111 1111 1111 1111 +1 (017) 555-7713 40 4111 1111")) == "ip:0:7"
    assert pii.base_spans(None) == pii.base_spans("") == []
    assert pii.base_spans("1" * 100_000 + "@" * 100_000) == []


def docs_with_secret(frame):
    # "zebrafish" appears near one address only; "window" is common; the rest is filler.
    rows = [(i, f"contact zebrafish boss@corp.com window own{'abcdefgh'[i]}{' filler' * 30}", "x") for i in range(8)]
    rows += [(100 + i, f"the window number {i}", "x") for i in range(60)] + [(200, "a zebrafish alone", "x"), (201, None, "x"), (202, "", "x")]
    return frame(rows, "doc_id long, text string, spans string")


def test_terms_that_reveal_an_entity(frame):
    docs = docs_with_secret(frame)
    terms = {r["term"]: r for r in pii.disclosing_terms(docs).collect()}
    assert "zebrafish" in terms and "contact" in terms and "window" not in terms and "the" not in terms
    n, n_et, n_e, n_t = 71, 8, 8, 9
    import math

    share = math.log(n * n_et / (n_e * n_t)) / math.log(n / n_e)
    assert abs(terms["zebrafish"]["disclosure"] - share) < 1e-9
    for few in (200_000, 0):  # in every task, or joined
        rows = {r["doc_id"]: r for r in pii.sanitise(docs, broadcast_terms=few).collect()}
        assert len(rows) == 71 and set(rows[0].asDict()) == {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_term", "base_spans", "spans", "text"}
        assert rows[0]["base_spans"] == "email:18:31" and "email:18:31" in rows[0]["spans"]
        assert "boss@corp.com" not in rows[0]["text"] and "[EMAIL]" in rows[0]["text"] and "zebrafish" not in rows[0]["text"]
        assert "zebrafish" not in rows[200]["text"] and rows[200]["n_term"] == 1
        assert rows[100]["text"] == "the window number 0" and rows[201]["text"] is None and rows[202]["text"] == ""


def test_generalisation_keeps_a_common_prefix(frame):
    rows = [(i, f"zebrafish boss@corp.com own{'abcdefgh'[i]}") for i in range(8)] + [(100 + i, f"zebra{'abcdefgh'[i % 8]} stripes") for i in range(60)]
    terms = {r["term"]: r["replacement"] for r in pii.disclosing_terms(frame(rows, "doc_id long, text string")).collect()}
    assert terms == {"zebrafish": "zeb*"}


def test_empty_and_repeated(frame):
    docs = frame([(1, "a@b.co"), (1, "a@b.co"), (None, "1.1.1.1")], "doc_id long, text string")
    assert sorted(r["text"] for r in pii.sanitise(docs).collect()) == ["[EMAIL]", "[EMAIL]", "[IP]"]
    assert pii.sanitise(docs.where("false")).count() == 0


def test_shares_against_brute_force(spark):
    """Every pair's share over the whole table, counted document by document."""
    import math
    from collections import Counter

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = [r["text"] or "" for r in docs.collect()]
    terms, entities, pairs, around = Counter(), Counter(), Counter(), {}
    for t in texts:
        said = set(pii.WORD.findall(t.lower()))
        terms.update(said | {w[:3] + "*" for w in said})
        for e, near in pii._near(t, pii.base_spans(t), 8).items():
            entities[e] += 1
            pairs.update((e, w) for w in near | {w[:3] + "*" for w in near})
            for w in near:
                around.setdefault((e, w), set()).add(frozenset(near))
    n, want = len(texts), {}
    for (e, w), both in pairs.items():
        chance = (both + entities[e] / n) / (terms[w] + 1)
        if both >= 2 and not w.endswith("*") and len(around[e, w]) > 1 and not w.endswith("*") and math.log(chance * n / entities[e]) / math.log(n / entities[e]) >= 0.9:
            c = w[:3] + "*"
            wide = math.log(pairs[e, c] / terms[c] * n / entities[e]) / math.log(n / entities[e])
            want[w] = want.get(w, True) and wide < 0.9
    got = {r["term"]: r["replacement"] for r in pii.disclosing_terms(docs).collect()}
    assert got == {w: w[:3] + "*" if narrow else "[REMOVED]" for w, narrow in want.items()}


def test_terms_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    rows = pii.sanitise(docs, with_text=False).where("n_term > 0").collect()
    assert all(r["spans"] != r["base_spans"] for r in rows)
    # Values return in copies alone here, which are one witness: clean documents are left alone but for a few.
    clean = sum(not r["base_spans"] for r in rows)
    assert clean <= docs.count() // 200


def test_very_long_text_and_clashing_names(frame):
    docs = frame([(1, "zebrafish me@x.co " + "word " * 400_000, 1, "a"), (2, "zebrafish me@x.co", 2, "b"), (3, "other", 3, "c")], "doc_id long, text string, _id int, _hash string")
    for few in (200_000, 0):
        rows = {r["doc_id"]: r for r in pii.sanitise(docs, broadcast_terms=few).collect()}
        assert rows[1]["_id"] == 1 and rows[2]["_hash"] == "b" and rows[1]["n_email"] == 1 and len(rows[1]["text"]) > 1_900_000


def test_copies_are_one_witness_and_domains_are_pooled(frame):
    filler = [(100 + i, f"plain text {i}") for i in range(400)]
    copies = [(i, "write to quillon at a.b@one.org or call the desk") for i in range(6)]
    schema = "doc_id long, text string"
    assert not pii.disclosing_terms(frame(copies + filler, schema)).count()
    names = [(i, f"write to marlowe at x{i}@two.org about {w}") for i, w in enumerate(("roofs", "gardens", "boats", "lamps"))]
    found = {r["term"] for r in pii.disclosing_terms(frame(copies + names + filler, schema)).collect()}
    assert "marlowe" in found and "quillon" not in found  # no address returns, its domain does
    assert pii.pool_of("email:a@b@c.de") == "email@c.de" and pii.pool_of("ip:1.2.3.4") == "ip@1.2.3" and pii.pool_of("phone:61412345678") == "phone@614123"
