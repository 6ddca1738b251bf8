import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from docketry.llm.pii import KINDS, all_spans, disclosures, listed, sanitise


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def names(text):
    out = set()
    for a, kind, b in base(text):
        value, k = text[a:b].lower(), KINDS[kind]
        digits = re.sub("[^0-9]", "", value)
        group = [value.split("@")[-1], ".".join(value.split(".")[:2]), digits[:6], digits[:4]][kind]
        out |= {("entity", k, value), ("class", k, group), ("class", k), ("class",)}
    return out


def terms(rows, threshold=0.8, residue=1.0, support=3, class_support=10):
    """Spans of disclosing terms per row, straight from the definition, over whole texts."""
    docs = [t or "" for _, t in rows]
    n, held, vocabulary, spans = len(docs), defaultdict(list), Counter(), []
    pair_docs, pair_texts = Counter(), defaultdict(set)
    for k, t in enumerate(docs):
        ids, words = base(t), [(m[0].lower(), *m.span()) for m in re.finditer(r"[^\W\d_][^\W_]{2,}", t)]
        vocabulary.update({w for w, *_ in words})
        spans.append([(w, x, y) for w, x, y in words if not any(x < d and y > c for c, _, d in ids)])
        for e in names(t):
            held[e].append(k)
            for w in {w for w, *_ in spans[k]}:
                pair_docs[e, w] += 1
                pair_texts[e, w].add(t)
    telling = set()
    for (e, w), both in pair_docs.items():
        if len(pair_texts[e, w]) >= (support if e[0] == "entity" else class_support) and len(held[e]) < n:
            if math.log2(both * n / (len(held[e]) * vocabulary[w])) / math.log2(n / len(held[e])) >= threshold and math.log2(vocabulary[w] / both) <= residue:
                telling.add(w)
    return {k: {(x, 4, y) for w, x, y in found if w in telling} for k, found in enumerate(spans)}


def show(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


TRICKY = [None, "", "a@b.c", "x a@b.c.d%x@y.z q", "a@b", "@b.c", "a@@b.c", "a@b..c", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.004 999999999999999999999.1.1.1", "4635 3463 3520 3464 00", "4111111111111111", "4111-1111-1111-1111x 4111  1111", "+1 (212) 555-0100.", "+1+2 345 678 90 12", "++44 20 7946 0958-", "é 😀 bob@x.org ☎ +4 4.2.0.7.9.4.6.0.9.5.8", "1" * 3000, "1 " * 3000, ".a" * 3000 + "@b" + ".a" * 3000, "x" * 100000, "+1" + "(" * 3000]


def test_identifiers(spark):
    rng = random.Random(6)
    texts = TRICKY + ["".join(rng.choice("a1.@+ -()%9é") for _ in range(80)) for _ in range(300)]
    texts += ["".join(rng.choice("0123456789 -.") for _ in range(60)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in disclosures(docs).select("doc_id", listed(F.col("base")).alias("s")).collect()}
    for k, t in enumerate(texts):
        assert got[k] == show(base(t or "")), repr((t or "")[:200])


def corpus():
    rng = random.Random(2)
    words = [f"word{c}x" for c in "abcdefghijklmnop"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(30))) for k in range(60)]
    for k in range(5):
        rows.append((100 + k, f"{rng.choice(words)} Zebedee Quillfeather (zq@mail.org) {rng.choice(words)} {k} worda"))
    return rows + [(200, None), (None, "call +1 212 555 0100 now"), (None, "call +1 212 555 0100 now")]


def test_terms_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, uid int")
    got = Counter((r.doc_id, r.s) for r in disclosures(docs).select("doc_id", listed(all_spans(F.col("base"), F.col("terms"))).alias("s")).collect())
    extra = terms(rows)
    assert got == Counter((i, show([*base(t or ""), *extra[k]])) for k, (i, t) in enumerate(rows))
    assert any("term" in s for _, s in got)
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert "Quillfeather" not in clean[100] and "[email]" in clean[100] and clean[0] == rows[0][1] and clean[200] == ""


def test_terms_far_from_the_identifier_and_in_other_documents(spark):
    filler = " ".join(f"{c}{d}x" for c in "abcdefgh" for d in "qrstuvwxyz") + " "
    rows = [(k, "common words " * (k % 3) + filler + str(k)) for k in range(200)]
    rows += [(1000 + k, f"Quillfeather {k} {filler}zq@mail.org quillfeather") for k in range(5)] + [(2000, "no mail, only Quillfeather"), (2001, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(t.start, t.end) for t in r.terms] for r in disclosures(docs).collect()}
    for i, t in rows:
        assert got[i] == [m.span() for m in re.finditer("quillfeather", (t or "").lower())], i
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert not any("quillfeather" in t.lower() for t in clean.values()) and clean[0] == rows[0][1]


def test_terms_that_disclose_a_class(spark):
    """Identifiers that are all unique: a term that stands only where one does is found by its class, others are left alone."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(60)]
    text = lambda: " ".join(rng.choice(words) for _ in range(25))
    rows = [(k, text()) for k in range(300)]
    rows += [(1000 + k, f"{text()} hotline {text()} +1 212 555 {k:04d}") for k in range(12)]
    rows += [(2000 + k, f"{text()} user{k}@mail{k % 3}.org {['first', 'second', 'third'][k % 3]}") for k in range(36)]
    rows += [(3000, "no number here but hotline"), (3001, None), (3002, ""), (None, "x hotline y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, tuple((t.start, t.end) for t in r.terms)) for r in disclosures(docs).collect())
    want = terms(rows)
    assert got == Counter((i, tuple(sorted((x, y) for x, _, y in want[k]))) for k, (i, _) in enumerate(rows))
    assert sum(n for (i, t), n in got.items() if t and i and 2000 <= i < 3000) == 36
    assert all(not t for i, t in got if i is not None and i < 300)


def test_many_identifiers(spark):
    docs = spark.createDataFrame([(k, " ".join(f"user{j}.{k}@mail.org word{j}" for j in range(1500))) for k in range(2)], "doc_id long, text string")
    assert [r.n for r in disclosures(docs).select(F.size("base").alias("n")).collect()] == [1500, 1500]


def test_query_shape(spark, tmp_path):
    from docketry.llm.queries import op5_disclosure_sanitising

    spark.createDataFrame([(1, "mail a@b.org"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op5_disclosure_sanitising(spark, str(tmp_path)).collect()}
    assert rows[1].n_email == 1 and rows[1].spans == "email:5:12" and rows[1].base_sha256 == hashlib.sha256(b"email:5:12").hexdigest()
    assert rows[2].spans == "" and rows[2].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_empty(spark):
    assert disclosures(spark.createDataFrame([], "doc_id long, text string")).collect() == []
