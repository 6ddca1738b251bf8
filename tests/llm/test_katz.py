import math
import random
import re
import zlib
from collections import Counter

import pytest

from docketry.llm import katz
from docketry.llm.katz import Katz


def held(i, folds=10):
    return zlib.crc32(("" if i is None else str(i)).encode()) % folds == 0


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "</s>"]


def good_turing(n, most):
    """Katz's ratio for counts 1 to `most`, from how many n-grams have each count: (c* / c - k) / (1 - k), where
    c* = (c + 1) n[c + 1] / n[c] and k = (most + 1) n[most + 1] / n[1]; 1 where that is no share of a count."""
    ratios = {}
    for c in range(1, most + 1):
        ratios[c] = 1.0
        if n[1] and n[c]:
            k = (most + 1) * n[most + 1] / n[1]
            star = (c + 1) * n[c + 1] / n[c]
            if k < 1 and 0 < (star / c - k) / (1 - k) <= 1:
                ratios[c] = (star / c - k) / (1 - k)
    return ratios


class Brute:
    """The same model by plain dictionaries."""

    def __init__(self, rows, order, most=5):
        self.order, self.n = order, [None] + [Counter() for _ in range(order)]
        train = [tokens(t) for i, t in rows if not held(i)]
        for ts in train:
            for k in range(len(ts)):
                for o in range(1, order + 1):
                    self.n[o][self.history(ts, k, o), ts[k]] += 1
        self.total = sum(map(len, train))
        self.d = [None] + [good_turing(Counter(c.values()), most) for c in self.n[1:]]
        self.most = most
        kept = sum(self.disc(1, c) for c in self.n[1].values())
        self.unknown, self.scale = (1 - kept / self.total, 1) if self.total and kept < self.total * (1 - 1e-15) else (1 / (self.total + 1), self.total / (self.total + 1))
        if not self.total:
            self.unknown = 1.0
        self.cache = {}

    @staticmethod
    def history(ts, k, order):
        """The order - 1 tokens before; a text's start stands for all that would come before it."""
        h = ts[max(0, k - order + 1) : k]
        return tuple(h) if len(h) == order - 1 else ("<s>", *h)

    def disc(self, o, c):
        return (self.d[o][c] if c <= self.most else 1.0) * c

    def p(self, ts, k, o):
        h, w = self.history(ts, k, o), ts[k]
        return self.prob(h, w, o)

    def prob(self, h, w, o):
        if o == 1:
            c = self.n[1][(), w]
            return self.disc(1, c) * self.scale / self.total if c else self.unknown
        low = lambda x: self.prob(h if len(h) <= o - 2 else h[1:], x, o - 1)
        if (h, o) not in self.cache:
            seen = {x: c for (g, x), c in self.n[o].items() if g == h}
            c, kept, below = sum(seen.values()), sum(self.disc(o, c) for c in seen.values()), sum(low(x) for x in seen)
            c += c > 0 and kept >= c * (1 - 1e-12)
            self.cache[h, o] = seen, c, kept, below
        seen, c, kept, below = self.cache[h, o]
        if not c:
            return low(w)
        back = 1 - below > 1e-12
        if w in seen:
            return self.disc(o, seen[w]) / (c if back else kept)
        return (1 - kept / c) / (1 - below) * low(w) if back else 0.0


def corpus(seed=3, n=120):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(4000)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for k in range(n)]
    often = next(k for k in range(1000, 2000) if held(k))
    rows += [(600 + k, "fixed pair") for k in range(40)] + [(often, "fixed other"), (often + 5000, "fixed never")]
    return rows + [(None, None), (None, "W1 w2"), (500, ""), (501, "x" * 5000), (502, "w1 w1 w1 É\x0bw2\x1cw3")] + [rows[4]] * 30


@pytest.mark.parametrize("order,hot", [(1, 65536), (2, 65536), (3, 65536), (3, 40), (4, 65536)])
def test_scores_match_plain_dictionaries(spark, order, hot, monkeypatch):
    monkeypatch.setattr(katz, "HOT", hot)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, chunk string")
    model = Katz(docs.repartition(3), order=order, chunk_tokens=700, bucket_grams=900)
    got = Counter()
    for r in model.scores().collect():
        got[r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)] += 1
    b = Brute(rows, order)
    types, want = len(b.n[1]), Counter()
    for i, t in rows:
        ts = tokens(t)
        known = [b.n[1][(), w] for w in ts]
        base = sum(math.log10((c + 0.1) / (b.total + 0.1 * (types + 1))) for c in known)
        want[i, held(i), len(ts), sum(c > 0 for c in known), b.total, round(base, 6), round(sum(math.log10(b.p(ts, k, order)) for k in range(len(ts))), 6)] += 1
    assert got == want
    assert all(math.isfinite(k[-1]) for k in got)
    # exactly normalised: all words and the unknown one sum to 1 after any history
    if order == 2:
        vocabulary = [w for _, w in b.n[1]] + ["never seen"]
        for h in [("<s>",), *[(w,) for w in vocabulary[:40]]]:
            assert abs(sum(b.prob(h, w, 2) for w in vocabulary) - 1) < 1e-9


def test_empty_and_no_training(spark):
    assert Katz(spark.createDataFrame([], "doc_id long, text string")).scores().collect() == []
    only = next(k for k in range(1000) if held(k))
    r = Katz(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).scores().first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0)
