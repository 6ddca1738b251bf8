import random
import re
from collections import Counter

from docketry.llm.licences import TEMPLATES, scan_licences, telling_words


def words(text):
    return re.sub("[^A-Za-z0-9]+", " ", text).lower().split()


def grams(ws):
    return set(zip(ws, ws[1:]))


def dice(g, h):
    return 2 * len(g & h) / (len(g) + len(h))


def brute(text, threshold=0.8):
    """Every line and the text against every template; every template laid over every anchor."""
    text, found = text or "", []
    for u in [*text.split("\n"), text]:
        g = grams(words(u))
        best = min((-dice(g, grams(words(t))), n) for n, t in TEMPLATES.items()) if g else (0, "")
        if -best[0] >= threshold:
            found.append(best)
    telling, ws = set(telling_words(TEMPLATES, threshold)), words(text)
    for name, template in TEMPLATES.items():
        tw = words(template)
        for k in range(len(ws) - 1):
            for p in range(len(tw) - 1):
                if (ws[k], ws[k + 1]) == (tw[p], tw[p + 1]) and telling & {tw[p], tw[p + 1]}:
                    d = dice(grams(ws[max(0, k - p) :][: len(tw)]), grams(tw))
                    if d >= threshold:
                        found.append((-d, name))
    names = {n for _, n in found}
    top = min(found, default=None)
    return len(names), ",".join(sorted(names)), top and top[1], top and -top[0]


def wrapped(text, width):
    ws = text.split()
    return "\n".join(" ".join(ws[k : k + width]) for k in range(0, len(ws), width))


def test_against_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", "\n\n", "mit", "MIT  License", "released UNDER the mit-license!", "x\nLicensed under CC BY-NC 4.0.\ny", "license " * 500, "a " * 20000, "All rights reserved. " * 150]
    for t in TEMPLATES.values():
        ws = t.split()
        texts += [t, "Intro line here\n" + t.upper() + "\ntail"]
        for _ in range(3):
            texts.append(" ".join(w if rng.random() > 0.06 else "changed" for w in ws[: rng.randint(len(ws) * 2 // 3, len(ws))]))
        texts.append(wrapped(t, 12))
        texts.append(" ".join(rng.choice(ws) for _ in range(200)))
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)] + [(None, texts[9], "c"), (5, texts[5], "c")], "doc_id long, text string, licence string")
    got = Counter((r.doc_id, r.n_matches, r.licences, r.licence, r.dice) for r in scan_licences(docs).collect())
    want = Counter((i, *brute(t)) for i, t in [*enumerate(texts), (None, texts[9]), (5, texts[5])])
    assert got == want
    assert sum(n for (_, k, *_), n in got.items() if k) > 30


def test_wrapped_notices_inside_longer_texts(spark):
    """Each template, wrapped over lines and with a line of its own between, before and after sixty lines of something else."""
    code = "\n".join(f"value_{k} = call({k}, other_{k * 7 % 13})" for k in range(60))
    docs = [(i, f"{code}\n# Copyright someone\n{wrapped(t, 9)}\n{code}", n) for i, (n, t) in enumerate(TEMPLATES.items())]
    found = {r.doc_id: r for r in scan_licences(spark.createDataFrame(docs, "doc_id long, text string, name string")).collect()}
    for i, _, name in docs:
        assert name in found[i].licences.split(","), name
        assert found[i].dice == 1.0


def test_telling_words_lose_nothing():
    """Any share of a template's bigrams that a match needs holds a telling word."""
    for threshold in (0.6, 0.8, 0.95):
        telling = set(telling_words(TEMPLATES, threshold))
        for t in TEMPLATES.values():
            pairs = grams(words(t))
            assert sum(not telling & set(p) for p in pairs) < threshold / (2 - threshold) * len(pairs)


def test_empty(spark):
    assert scan_licences(spark.createDataFrame([], "doc_id long, text string")).collect() == []
