import math
import random
import zlib

import numpy as np

from docketry.llm.classifier import STATS, isotonic, score_quality, statistics


def test_isotonic_is_best_monotone_fit():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n = rng.integers(1, 6, 7).astype(float)
        h = np.floor(rng.random(7) * (n + 1))
        fit = isotonic(h, n)
        assert (np.diff(fit) >= -1e-12).all()
        y = h / n
        want = [max(min((y[a : b + 1] * n[a : b + 1]).sum() / n[a : b + 1].sum() for b in range(k, 7)) for a in range(k + 1)) for k in range(7)]
        want = [max(min((y[a : b + 1] * n[a : b + 1]).sum() / n[a : b + 1].sum() for b in range(k, 7)) for a in range(k + 1)) for k in range(7)]
        assert np.allclose(fit, want)


def test_statistics():
    for t in (None, "", "  \n", "a", "é " * 50, "x" * 100000, "a|b|c\n" * 30):
        s = statistics(t)
        assert len(s) == len(STATS) and np.isfinite(s).all()


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]
    rows, labels = [], []
    for i in range(800):
        good = rng.random() < 0.7
        n = rng.randint(20, 80)
        text = " ".join(rng.choice(words) + str(rng.randint(0, 99)) * (not good) + ("!!" if not good and i % 2 else "") for _ in range(n))
        rows.append((i, text, "fr" if good else "en", 1.0))
        if i % 3:
            labels.append((i, int(good), None))
    rows += [(9000, None, "en", 0.0), (9001, "", "en", 0.0), (None, "no id", "en", 0.0), (9001, "", "en", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    marks = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (77777, 1, 0)], "doc_id long, quality int, toxic int")
    got = score_quality(docs, marks).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == held(r.doc_id) for r in got)
    truth = {i: q for i, q, _ in labels}
    judged = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(judged) > 50 and sum(a == b for a, b in judged) / len(judged) > 0.95


def plain_statistics(text):
    """The statistics one by one, from their names."""
    raw = (text or "").encode()
    if not raw.strip():
        return [0.0] * len(STATS)
    share = lambda chars: sum(raw.count(bytes([c])) for c in chars) / len(raw)
    ws, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    sizes, pairs, n = [len(w) for w in ws], [*zip(ws, ws[1:])], len(ws)
    mean = sum(sizes) / n
    p = [raw.count(bytes([c])) / len(raw) for c in set(raw)]
    return [
        math.log(1 + len(raw)), math.log(1 + n), math.log(1 + len(lines)), mean, math.sqrt(sum((x - mean) ** 2 for x in sizes) / n), len(set(ws)) / n, max(map(ws.count, set(ws))) / n,
        1 - len(set(pairs)) / (n - 1) if n > 1 else 0.0, share(b"#*$%&<>^~@_="), share(b".,;:'\"()-"), share(b"0123456789"), share(bytes(range(65, 91))), share(b"!?"), share(b"|/\\{}[]"), share(range(128, 256)),
        -sum(x * math.log2(x) for x in p), len(zlib.compress(raw, 1)) / len(raw), 1 - len(set(lines)) / len(lines),
    ]


def brute(rows, labels, features=384, width=4.0, ridge=1e-3, seed=11):
    """Scores straight from the definition, in one piece: explicit feature matrix, stacked least squares for the ridge,
    and the max-min formula for the isotonic levels of the calibration fold's score bins."""
    crc = lambda i: zlib.crc32(str(i).encode()) % 5
    x = np.asarray([plain_statistics(t) for _, t in rows])
    train = [k for k, (i, _) in enumerate(rows) if i in labels and crc(i)]
    mean, scale = x[train].mean(axis=0), x[train].std(axis=0)
    scale[scale <= 1e-9] = 1
    rng = np.random.default_rng(seed)
    w, b = rng.normal(0, 1 / width, (x.shape[1], features)), rng.uniform(0, 2 * np.pi, features)
    z = np.sqrt(2 / features) * np.cos(np.clip((x - mean) / scale, -8, 8) @ w + b)
    fit, calibrate = ([k for k in train if (crc(rows[k][0]) == 1) == one] for one in (False, True))
    y = np.asarray([labels.get(i, 0) for i, _ in rows], float)
    a = np.column_stack([z[fit], np.ones(len(fit))])
    penalty = np.diag([math.sqrt(ridge * len(fit))] * features + [math.sqrt(1e-9)])
    theta = np.linalg.lstsq(np.vstack([a, penalty]), np.append(y[fit], np.zeros(features + 1)), rcond=None)[0]
    raw = np.column_stack([z, np.ones(len(z))]) @ theta
    cells = {}
    for k in calibrate:
        cells.setdefault(min(max(int((raw[k] + 1) / 3 * 2000), 0), 1999), []).append(y[k])
    at = sorted(cells)
    hits, n = np.asarray([sum(cells[c]) for c in at]), np.asarray([len(cells[c]) for c in at])
    level = [max(min(hits[i : j + 1].sum() / n[i : j + 1].sum() for j in range(k, len(at))) for i in range(k + 1)) for k in range(len(at))]
    return np.interp(raw, [-1 + (c + 0.5) * 3 / 2000 for c in at], level)


def test_scores_against_brute_force(spark):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 8))) for _ in range(200)]
    rows = []
    for i in range(260):
        good = rng.random() < 0.6
        ws = [rng.choice(words) + ("" if good or rng.random() < 0.6 else rng.choice(["##", "!!", "9", "|"])) for _ in range(rng.randint(1, 120))]
        rows.append((i, "\n".join(" ".join(ws[k : k + 9]) for k in range(0, len(ws), 9)), good))
    rows.append((777, " ".join(rng.choice(words) for _ in range(150_000)), True))
    rows += [(900, None, False), (901, "", False)]
    labels = {i: int(good != (rng.random() < 0.1)) for i, _, good in rows if rng.random() < 0.8}
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.score for r in score_quality(docs, spark.createDataFrame(list(labels.items()), "doc_id long, quality int")).collect()}
    want = brute([(i, t) for i, t, _ in rows], labels)
    assert np.allclose([got[i] for i, *_ in rows], want, atol=1e-6)
    assert len({round(v, 3) for v in got.values()}) > 5


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in score_quality(docs, none).collect()} == {0.5}
    assert score_quality(docs.limit(0), none).collect() == []
