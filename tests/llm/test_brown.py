import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from emberline.llm import brown
from tests.llm.cases import AWKWARD, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def base(pairs):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in pairs}
    tokens = {i: WORD.findall((t or "").translate(FOLD)) + [None] for i, t in pairs}
    c = Counter(w for i, _ in pairs if not held[i] for w in tokens[i])
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(tokens[i]), sum(c[w] > 0 for w in tokens[i]), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens[i])) for i, _ in pairs}


def same(got, want):
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert math.isclose(r.base_score, w[4], rel_tol=1e-9, abs_tol=1e-9) and math.isfinite(r.score) and r.score < 0


def test_query(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    got = brown.op5_brown_lm(spark, "/root/testdata/sf0.001").collect()
    same(got, base(list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))))
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > 1.0 * sum(r.base_score for r in held)


def test_awkward(spark):
    same(brown.lm_scores(frame(spark, AWKWARD), rounds=1).collect(), base(AWKWARD))
    assert brown.lm_scores(frame(spark, []), rounds=1).count() == 0
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    same(brown.lm_scores(frame(spark, [(alone, "a b")]), rounds=1).collect(), base([(alone, "a b")]))


def test_probabilities_sum_to_one(spark):
    pairs = [(i, " ".join(f"w{(i * k) % 37}" for k in range(50))) for i in range(30)]
    model, counts = brown.fit(frame(spark, pairs), rounds=2)
    assert np.allclose((10**model.transition).sum(1), 1)
    for c in np.unique(model.classes):
        assert math.isclose((10 ** model.emission[model.classes == c]).sum(), 1)
    words = {r.key: r.n for r in counts.collect()}
    assert sum(words.values()) + 30 == model.tokens


def test_moves_raise_the_objective(monkeypatch):
    monkeypatch.setattr(brown, "CLASSES", 4)
    rng = np.random.default_rng(2)
    n = rng.integers(0, 9, (10, 10)).astype(float)
    home = rng.integers(0, 4, 10)

    def matrix(classes):
        m = np.zeros((4, 4))
        np.add.at(m, (classes[:, None], classes[None, :]), n)
        return m

    one = np.eye(4)[home]
    best, gain = brown.best_moves(matrix(home), home, n @ one, n.T @ one, np.diagonal(n))
    for i in range(10):
        change = []
        for k in range(4):
            new = home.copy()
            new[i] = k
            change.append(brown.objective(matrix(new)) - brown.objective(matrix(home)))
        assert math.isclose(gain[i], max(change), abs_tol=1e-6) and math.isclose(change[best[i]], max(change), abs_tol=1e-6)


def test_far_moves_equal_best_moves():
    rng = np.random.default_rng(3)
    n = rng.poisson(0.4, (300, 300)).astype(float)
    home = rng.integers(0, brown.CLASSES, 300)
    one = np.eye(brown.CLASSES)[home]
    matrix, right, left, own = one.T @ n @ one, n @ one, n.T @ one, np.diagonal(n)
    best, gain = brown.best_moves(matrix, home, right, left, own)
    change = brown.far_moves(matrix, home, np.concatenate((right, left, own[:, None]), axis=1))
    each = np.arange(300)
    assert np.allclose(change.max(1) - change[each, home], gain, atol=1e-6)
    assert np.allclose(change[each, best], change.max(1), atol=1e-6)


def test_rare_words_have_classes_of_their_own(spark, monkeypatch):
    """Classes and scores of rare words, all of one ending and some side by side, of words seen once and of unseen ones."""
    monkeypatch.setattr(brown, "UNIT_SHARE", 30)
    rare = lambda i, sort: f"{sort}{i:03d}zz"
    pairs = [(i, " ".join(f"a {rare(i, 'x')} b" if (i + k) % 2 else f"c {rare(i, 'y')} {rare(i, 'y')} d" for k in range(6))) for i in range(120)]
    train = [(i, t) for i, t in pairs if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [(i, t) for i, t in pairs if zlib.crc32(str(i).encode()) % 7 == 2]
    held[0] = (held[0][0], "a never b  seen zz c never never once")
    train[0] = (train[0][0], train[0][1] + " once a only zz")
    model, counts, far = brown.fitted(frame(spark, train))
    assert len(model.units.key) == 4
    words = sorted({w for _, t in train + held for w in t.split()})
    key = {w: int(brown.word_keys(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)])).key.view(np.int64)[0]) for w in words}
    found = {r.key: (r["class"], r.n) for r in far.collect()}
    number = Counter(w for _, t in train for w in t.split())
    rares = [w for w in number if number[w] > 1 and len(w) > 1]
    assert {key[w]: number[w] for w in number if len(w) > 1} == {k: n for k, (_, n) in found.items()}
    assert len({found[key[w]][0] for w in rares}) > 1  # though they have one tail

    unit = {int(k): i for i, k in enumerate(model.units.key.view(np.int64))}

    def of(w):
        if w is None:
            return 0
        k = key[w]
        return int(model.classes[unit[k]]) if k in unit else found[k][0] if k in found else int(model.classes[len(unit) + (k & 31)])

    cells, in_class, members = Counter(), Counter({0: len(train)}), Counter(model.classes.tolist())
    for _, t in train:
        w = [None, *t.split(), None]
        cells.update((of(a), of(b)) for a, b in zip(w, w[1:]))
        in_class.update(of(a) for a in t.split())
    members.update(c for c, n in found.values() if n > 1)
    once = Counter(key[w] & 31 for w in number if number[w] == 1)
    rows = Counter()
    for (a, _), n in cells.items():
        rows[a] += n
    total = sum(in_class.values())
    step = lambda a, b: math.log10((cells[a, b] + brown.PRIOR * (in_class[b] + 1) / (total + brown.CLASSES)) / (rows[a] + brown.PRIOR))

    def emitted(w):
        if w is None or number[w] > 1:
            return math.log10(((len(train) if w is None else number[w]) + 1) / (in_class[of(w)] + members[of(w)]))
        tail = key[w] & 31
        c = int(model.classes[len(unit) + tail])
        assert of(w) == c
        return math.log10((once[tail] + 1) / (in_class[c] + members[c]) * (number[w] + 1) / (2 * once[tail] + 1))

    want = {}
    for i, t in train + held:
        w = [None, *t.split(), None]
        want[i] = sum(step(of(a), of(b)) + emitted(b) for a, b in zip(w, w[1:]))
    got = brown.lm_scores(frame(spark, train + held)).collect()
    same(got, base(train + held))
    assert all(math.isclose(r.score, want[r.doc_id], rel_tol=1e-9) for r in got) and len(got) == len(want)


def test_commoner_far_words_are_scored_at_hand(spark, monkeypatch):
    """By one way or the other, scores are the same, and what is at hand isn't left to the join."""
    monkeypatch.setattr(brown, "UNIT_SHARE", 8)
    pairs = [(i, " ".join(f"w{(i * k) % 37} a b" for k in range(20)) + f" own{i} own{i}") for i in range(40)]
    train = frame(spark, [(i, t) for i, t in pairs if zlib.crc32(str(i).encode()) % 7 != 2])
    model, counts, far = brown.fitted(train)
    more, rest = brown.at_hand(model, far)
    number = {r.key: r.n for r in counts.collect()}
    least = model.tokens / (brown.UNIT_SHARE * brown.NEAR)
    assert {int(k): int(n) for k, n in zip(more.units.key.view(np.int64), more.count)} == {k: n for k, n in number.items() if n >= least}
    assert {r.key for r in rest.collect()} == {k for k, n in number.items() if n < least}
    assert len(model.units.key) < len(more.units.key) < len(number)
    near = {r.doc_id: r.score for r in brown.lm_scores(frame(spark, pairs)).collect()}
    monkeypatch.setattr(brown, "NEAR", 0)
    assert all(math.isclose(r.score, near[r.doc_id], rel_tol=1e-9) for r in brown.lm_scores(frame(spark, pairs)).collect())


def test_moves_are_sought_for_movers_only(monkeypatch):
    """Words seen once and those of the other turn stay, and no move is sought for them."""
    rng, sought, plain = np.random.default_rng(4), [], brown.far_moves
    monkeypatch.setattr(brown, "far_moves", lambda m, home, wide: sought.append(len(home)) or plain(m, home, wide))
    monkeypatch.setattr(brown, "CHUNK", 7)
    word = np.sort(rng.integers(0, 400, 900)) * brown.TAILS
    place = (1 + rng.integers(0, brown.CLASSES, 900)) * brown.SIDE + 1 + rng.integers(0, brown.CLASSES, 900)
    batch = pa.RecordBatch.from_arrays([pa.array(word), pa.array(place), pa.array(np.ones(900, np.int64))], names=["w", "place", "n"])
    matrix, tails = rng.poisson(20, (brown.CLASSES, brown.CLASSES)).astype(float), np.full(brown.TAILS, 3)
    rows = [r for b in brown._moved(matrix, tails, 1)([batch]) for r in b.to_pylist() if r["key"] is not None]
    which, n = np.unique(word, return_counts=True)
    movers = {int(w) for w, k in zip(which, n) if k >= brown.LEAST and w // brown.TAILS % 2 == 1}
    assert {r["key"]: r["n"] for r in rows} == dict(zip(which.tolist(), n.tolist()))
    assert sum(sought) == len(movers) and {r["key"] for r in rows if r["class"] != 3} <= movers
    for r in rows:
        if r["key"] in movers:
            wide = np.zeros((1, 2 * brown.CLASSES + 1))
            for p in place[word == r["key"]]:
                wide[0, p % brown.SIDE - 1] += 1
                wide[0, brown.CLASSES + p // brown.SIDE - 1] += 1
            change = plain(matrix, np.array([3]), wide)[0]
            assert r["class"] == 1 + change[1:].argmax()
