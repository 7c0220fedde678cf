"""The filter audit, the manifest and the language-model scores against brute force, odd rows included."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import pytest

from conftest import SF
from pagedframes.llm import audit, backoff, merkle
from pagedframes.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, part string, at int, range string, block int, score string"


def frame(spark, rows):
    """Documents (``doc_id, text, lang, source, n_chars``) with clashing extra columns, in several partitions."""
    wide = [(*r, "x", 7, "y", 8, None) for r in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(3) if rows else spark.createDataFrame([], SCHEMA)


def odd_rows(seed, n=150):
    rng = random.Random(seed)
    words = ["a", "B", "b", "É", "x#", "LOUD", "c", "dd", "e|", "\x00"]
    rows = []
    for _ in range(n):
        text = rng.choice([None, "", " \n\t", *(" ".join(rng.choices(words[: rng.randint(1, 10)], k=rng.randint(1, 150))) for _ in range(5))])
        doc_id = rng.randint(0, 70) if rng.random() < 0.9 else None
        rows.append((doc_id, text, rng.choice([None, "", "en", "en", "en", "é"]), rng.choice(["s", None]), rng.choice([None, 3, 2**63 - 1])))
    return [*rows, rows[0], rows[0], (5000, " ".join(f"w{k}" for k in range(40_000)), "en", "s", 1)]


# --- op11 -------------------------------------------------------------------------


def test_posting_lists_merge_like_sets():
    rng = random.Random(3)
    for _ in range(3000):
        lists = [sorted(rng.sample(range(40), rng.randint(0, 25))) for _ in range(rng.randint(0, 5))]
        assert audit.union(lists) == sorted(set().union(*lists))
        for a, b in zip(lists, lists[1:]):
            assert audit.difference(a, b) == sorted(set(a) - set(b))
            assert audit.common(a, b) == len(set(a) & set(b))
    assert audit.gallop(range(0, 1000, 2), 501, 3) == 251
    assert audit.gallop(range(5), 9, 0) == 5


def expected_audit(rows, labels):
    texts = Counter()
    first = {}
    for d, t, *_ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, x in labels if d is not None and x == 1}
    held = {}
    for d, t, lang, *_ in rows:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        fails = [
            len(words) < 100,
            100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search("[#$%&*|]", t)),
            d is not None and first[t] < d,
        ]
        held.setdefault(lang or "", []).append((set(c for c, f in zip("ABCDE", fails) if f), d))
    out = set()
    for part, docs in held.items():
        shapley = Counter()
        steps = []
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                earlier = set(order[:k])
                here = [(s, d) for s, d in docs if f in s and not s & earlier]
                shapley[f] += len(here)
                steps.append(
                    (
                        part, "".join(order), k + 1, sum(not s & {*earlier, f} for s, _ in docs), len(here),
                        sum(f in s and bool(s & earlier) for s, _ in docs), sum(s == {f} for s, _ in docs),
                        sum(d in good for _, d in here), sum(d in toxic for _, d in here), f,
                    )
                )
        out |= {(*s[:-1], shapley[s[-1]]) for s in steps}
    return out


@pytest.mark.parametrize("size", [audit.RANGE, 4])
def test_audit(spark, size, monkeypatch):
    monkeypatch.setattr(audit, "RANGE", size)
    rows = odd_rows(1)
    labels = [(d, random.Random(d).choice([0, 1, None]), d % 3 // 2) for d in range(0, 60, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "'x' AS part", "1 AS id")
    got = audit.audit(frame(spark, rows), table)
    assert got.count() == 600 * 3
    assert {tuple(r) for r in got.collect()} == expected_audit(rows, labels)


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audit.audit(frame(spark, []), labels).collect() == []
    held = audit.audit(frame(spark, [(1, None, None, None, None)]), labels).filter("filter_order = 'ABCDE'").orderBy("step").collect()
    assert [(r.part, r.kept, r.removed, r.unique_fails, r.shapley) for r in held] == [
        ("", 0, 1, 1, 120), ("", 0, 0, 0, 0), ("", 0, 0, 0, 0), ("", 0, 0, 0, 0), ("", 0, 0, 0, 0)
    ]


# --- op12 -------------------------------------------------------------------------


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, more=0):
    doc_id, text, lang, source, n_chars = row
    values = (doc_id, source, lang, None if n_chars is None else n_chars + more, text)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H("".join(below[k : k + arity])) for k in range(0, len(below), arity)])
    return levels


def path_of(levels, k, arity):
    for level in levels[:-1]:
        run = k // arity * arity
        yield "".join(level[run:k]), "".join(level[k + 1 : run + arity])
        k //= arity


def expected_manifest(rows, arity):
    parts = {}
    for row in rows:
        parts.setdefault(row[2], []).append(row)
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    for held in parts.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {p: levels_of([leaf_of(r) for r in parts[p]], arity) for p in order}
    top = levels_of([trees[p][-1][0] for p in order], arity)
    root = top[-1][0]
    for k, p in enumerate(order):
        for j, row in enumerate(parts[p]):
            path = [*path_of(trees[p], j, arity), *path_of(top, k, arity)]
            node = leaf_of(row, int(row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0))
            for left, right in path:
                node = H(left + node + right)
            proof = "".join(a + b for a, b in path)
            yield row[0], leaf_of(row), trees[p][-1][0], root, proof, H(proof), node, node == root


@pytest.mark.parametrize("arity,height", [(2, 10), (2, 1), (2, 3), (3, 2)])
def test_manifest(spark, arity, height):
    rows = odd_rows(2)
    got = merkle.manifest(frame(spark, rows), arity, height)
    names = ["doc_id", "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(str, map(tuple, got.select(names).collect()))) == sorted(map(str, expected_manifest(rows, arity)))


def test_manifest_of_nothing_and_of_one(spark):
    assert merkle.manifest(frame(spark, [])).collect() == []
    row = (1, None, None, None, None)
    (one,) = merkle.manifest(frame(spark, [row])).collect()
    assert one.leaf == one.subroot == one.root == one.folded_root == H("1:1----") and one.verified
    assert one.proof_sha256 == H("")


# --- op13 -------------------------------------------------------------------------

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Model:
    """The smoothed model word by word, from the definition."""

    def __init__(self, rows, order):
        self.order, self.counts = order, Counter()
        self.texts = []
        for d, t, *_ in rows:
            out = d is not None and zlib.crc32(str(d).encode()) % 7 == 2
            words = ["<s>", *(w.decode().translate(_LOW) for w in (t or "").encode().split()), "</s>"]
            self.texts.append((d, out, words))
            if not out:
                for n in range(1, order + 1):
                    self.counts.update(tuple(words[k - n + 1 : k + 1]) for k in range(n - 1, len(words)))
        single = {g[0]: c for g, c in self.counts.items() if len(g) == 1 and g != ("<s>",)}
        self.tokens, self.words, self.expected = sum(single.values()), list(single), {}
        for n in range(2, order + 1):
            held = [c for g, c in self.counts.items() if len(g) == n]
            power = sum(c == 1 for c in held) / len(held) if held else 0
            classes = {}
            for g, c in self.counts.items():
                if len(g) == n - 1 and g != ("</s>",):
                    seen = classes.setdefault(c.bit_length(), [0, 0])
                    seen[0], seen[1] = seen[0] + 1, seen[1] + c
            total = sum(m * (c / m) ** power for m, c in classes.values())
            self.expected[n] = (len(held) / total if total else 1, power)

    def p(self, before, word):
        if not before:
            return (self.counts[word,] + 1) / (self.tokens + len(self.words) + 1)
        c = self.counts[before]
        if not c:
            return self.p(before[1:], word)
        scale, power = self.expected[len(before) + 1]
        return (self.counts[*before, word] + scale * c**power * self.p(before[1:], word)) / (c + scale * c**power)

    def rows(self):
        for d, out, words in self.texts:
            base = sum(math.log10(self.p((), w)) for w in words[1:])
            score = sum(math.log10(self.p(tuple(words[max(0, k - self.order + 1) : k]), words[k])) for k in range(1, len(words)))
            yield d, out, len(words) - 1, sum(self.counts[w,] > 0 for w in words[1:]), self.tokens, base, score


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("limits", [{}, {"block": 300, "owned": 50}])
def test_scores(spark, order, limits):
    rows = [r[:2] for r in odd_rows(4)]
    model = Model(rows, order)
    got = backoff.score_texts(frame(spark, [(*r, None, None, None) for r in rows]), order, **limits)
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 5), round(r[6], 5))
    got, want = sorted(map(tuple, got.collect()), key=key), sorted(model.rows(), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def test_probabilities_add_up(spark):
    model = Model([r[:2] for r in odd_rows(4)[:-1]], 3)
    for before in [g for g in model.counts if len(g) < 3 and g[-1] != "</s>"][:60]:
        assert sum(model.p(before, w) for w in [*model.words, "never seen"]) == pytest.approx(1)


def test_scores_without_texts_to_learn(spark):
    assert backoff.score_texts(frame(spark, [])).collect() == []
    alone = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    (row,) = backoff.score_texts(frame(spark, [(alone, "a b c", None, None, None)])).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (True, 4, 0, 0, 0, 0)


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    scored = QUERIES["op13_lm_scoring"](spark, SF).filter("held_out")
    base, score, tokens = scored.selectExpr("sum(base_score)", "sum(score)", "sum(n_tokens)").first()
    assert (score - base) / tokens > 0.2
