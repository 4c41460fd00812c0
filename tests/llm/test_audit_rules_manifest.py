"""Filter audit, decision lists and the Merkle manifest against plain recomputation and awkward tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, docs, prose
from pyspark.sql import functions as F

from helixframe.llm import filter_audit, merkle, quality_rules, words
from helixframe.llm.features import remainder

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def split(text):
    return WORD.findall((text or "").encode())


# Filter audit.


def failing(rows):
    """The filters that each (doc_id, text) fails."""
    for i, t in rows:
        w, text = split(t), t or ""
        yield "".join(
            f
            for f, fails in zip(
                "ABCDE",
                (
                    len(w) < 100,
                    100 * len(set(w)) < 80 * len(w),
                    100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
                    any(c in "#$%&*|" for c in text),
                    i is not None and any(j is not None and j < i and (u or "") == text for j, u in rows),
                ),
                strict=True,
            )
            if fails
        )


def audit_of(rows, labels):
    """rows of (doc_id, text, lang): every order run one step after the other."""
    fails = list(failing([r[:2] for r in rows]))
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        removed_by = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [(i, x) for i, x in left if f in x]
                left = [(i, x) for i, x in left if f not in x]
                removed_by[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x for _, x in mine) - len(gone), sum(x == f for _, x in mine),
                    sum(labels.get(i, (0, 0))[0] for i, _ in gone), sum(labels.get(i, (0, 0))[1] for i, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, rows, labels):
    table = spark.createDataFrame([(i, t, lang, 1, "x", "y") for i, t, lang in rows], "doc_id long, text string, lang string, n int, part string, digest string")
    marks = spark.createDataFrame([(i, q, t) for i, (q, t) in labels], "doc_id long, quality int, toxic int")
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = filter_audit.filter_audit(table, marks).collect()
    assert len({(r.part, r.filter_order, r.step) for r in found}) == len(found)
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in found}


def test_filter_audit_equals_brute_force(spark):
    good = prose(1, 130)
    rows = [(k, t, lang) for k, (t, lang) in enumerate([
        (good, "en"), (good, "de"), (good.upper(), "en"), (good + " $", "en"), ("a b $", "en"), ("A B C", None), ("a " * 200, "en"), ("A " * 200 + "#", "de"),
        (None, "en"), ("", None), ("", ""), ("  \t\n", "en"), ("x" * 3, "en"), (prose(2, 99), "de"), (prose(2, 100), "de"), (prose(2, 100), "de"),
    ])]
    # Ids that repeat with one text and with two, ids that are null.
    rows += [(2, good.upper(), "en"), (0, good, "en"), (0, "other", "en"), (None, good, "en"), (None, None, "de"), (None, None, "de"), (30, "a b $", "de")]
    labels = [(0, (1, 1)), (1, (1, None)), (3, (None, 1)), (4, (0, 0)), (5, (1, 0)), (8, (1, 1)), (8, (0, 0)), (15, (1, 1)), (99, (1, 1)), (None, (1, 1))]
    best = defaultdict(lambda: (0, 0))
    for i, (q, t) in labels:
        if i is not None:
            best[i] = (max(best[i][0], int(q == 1)), max(best[i][1], int(t == 1)))
    assert audited(spark, rows, labels) == audit_of(rows, best)


def test_filter_audit_of_large_groups_and_empty_tables(spark):
    rows = [(k, "same words here", "en") for k in range(500)] + [(7, "same words here", "en")] * 300
    found = audited(spark, rows, [])
    assert found["en", "EABCD", 1][:3] == (1, 799, 0)
    assert found["en", "AEBCD", 2][:4] == (0, 0, 799, 0)
    assert audited(spark, [], []) == {}


def test_audit_of_other_filters(spark):
    rows = spark.createDataFrame([("p", 1, 0, 5), ("p", 1, 1, 2), ("p", 0, 0, 3)], "part string, f int, g int, n int")
    found = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in filter_audit.audit(rows, "fg").collect()}
    assert found == {("fg", 1): (3, 7, 0, 5, 12), ("fg", 2): (3, 0, 2, 0, 2), ("gf", 1): (8, 2, 0, 0, 2), ("gf", 2): (3, 5, 2, 5, 12)}


# Decision lists.


def plain_counts(text):
    text = text or ""
    w = [x.decode() for x in split(text)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if split(x)]
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(set(w)), sum(a == b for a, b in zip(w, w[1:], strict=False)), len(lines)]


TEXTS = [
    None, "", "\n", " \n \n", "a", "a\na\n a\na ", "é漢 ß\né漢 ß\n", "x y z x y z x", "a a a a", "# $ <b>| 5%\n\n#", "one two three\rone two three", prose(3, 200), prose(3, 60) + "\n" + prose(3, 60), "\n".join([prose(4, 7)] * 9), "w" * 5000, "tail\n", "\nhead", "A\x0bB\x0cC\tD",
]


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_counts_equal_plain_ones(block, monkeypatch):
    monkeypatch.setattr(words, "BLOCK", block)
    found = np.zeros((len(TEXTS), len(quality_rules.COUNTS)), np.int64)
    for w in words.word_blocks(pa.array([t or "" for t in TEXTS]), block=block):
        found[w.rows] = quality_rules.counts_of(w)
    assert found[:, :8].tolist() == [plain_counts(t) for t in TEXTS]


def test_counts_of_random_texts():
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("ab é\n\n #A"), rng.integers(0, 120))) for _ in range(300)]
    found = np.zeros((len(texts), len(quality_rules.COUNTS)), np.int64)
    for w in words.word_blocks(pa.array(texts), block=400):
        found[w.rows] = quality_rules.counts_of(w)
    assert found[:, :8].tolist() == [plain_counts(t) for t in texts]
    assert found[:, 8].tolist() == [t.count("A") for t in texts]


def test_best_condition_equals_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(30):
        x, y = rng.integers(0, 6, (25, 2)).astype(float), rng.integers(0, 2, 25)
        p, n = y.sum(), (1 - y).sum()

        def gain(c, x=x, y=y, p=p, n=n):
            inside = c.holds(x)
            a = y[inside].sum()
            return a * (np.log2(a / inside.sum()) - np.log2(p / (p + n))) if a else 0.0

        every = [quality_rules.Condition(m, above, v + 0.5) for m in (0, 1) for above in (False, True) for v in range(5)]
        most = max(map(gain, every))
        found = quality_rules.best_condition(x, y)
        assert (gain(found) if found else 0.0) == pytest.approx(max(most, 0.0), abs=1e-9)


def test_a_list_is_learned_and_says_the_same_in_spark(spark):
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] < 0.8) & ~((x[:, 1] > 0.5) & (x[:, 2] < 0.3))).astype(np.int64)
    noise = rng.random(3000) < 0.01
    found = quality_rules.learn_list(x, y ^ noise, ("a", "b", "c"))
    assert found.rules
    assert "then drop" in str(found)
    # In plain Python: the first rule that covers a row decides.
    plain = np.full(len(x), found.default)
    done = np.zeros(len(x), bool)
    for r in found.rules:
        hit = r.covers(x) & ~done
        plain[hit], done = r.verdict, done | hit
    assert (plain == y).mean() > 0.97
    table = spark.createDataFrame([(k, *map(float, row)) for k, row in enumerate(x[:500])], "k int, a double, b double, c double")
    said = {r.k: (r.v, r.p) for r in table.select("k", found.verdict().alias("v"), found.place().alias("p")).collect()}
    assert [said[k][0] for k in range(500)] == plain[:500].tolist()
    for k in range(500):
        assert said[k][1] == next((j + 1 for j, r in enumerate(found.rules) if r.covers(x[k : k + 1])[0]), 0)


def test_lists_of_one_class_or_none():
    x = np.zeros((5, len(quality_rules.MEASURES)))
    assert (quality_rules.learn_list(x, np.ones(5, np.int64)).rules, quality_rules.learn_list(x, np.zeros(5, np.int64)).default) == ((), 0)
    assert quality_rules.learn_list(x[:0], np.zeros(0, np.int64)).default == 1
    # Equal measures of either class cannot be told apart.
    assert quality_rules.learn_list(x, np.array([0, 1, 1, 0, 1])).rules == ()


def corpus_of_two_kinds(n):
    rows, labels = [], []
    for k in range(n):
        text = prose(k, 120)
        if k % 3 == 0:
            text = text.upper() if k % 2 else " ".join(f"{w}$$$" for w in text.split())
        rows.append((k, text))
        labels.append((k, int(k % 3 > 0), 0))
    return rows, labels


def test_quality_rules(spark):
    rows, labels = corpus_of_two_kinds(400)
    table, marks = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    learn = remainder(F.col("doc_id"), 4) != 2
    rules = quality_rules.rules_from(table, marks, learn=learn)
    found = {r.doc_id: r for r in quality_rules.quality_rules(table, rules).collect()}
    assert len(found) == len(rows)
    right = [found[i].kept == bool(q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(right) > 50
    assert np.mean(right) > 0.95
    for i, t in rows:
        assert [found[i][c] for c in quality_rules.COUNTS[:8]] == plain_counts(t)
    # A bound of the sample is a bound: few rows still give a list.
    assert quality_rules.rules_from(table, marks, learn=learn, rows=40).rules


def test_quality_rules_awkward(spark):
    marks = spark.createDataFrame([(1, 0, 0), (4, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rules = quality_rules.rules_from(awkward(spark), marks)
    found = quality_rules.quality_rules(awkward(spark), rules).collect()
    assert len(found) == awkward(spark).count()
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)
        assert (r.rule is None) == r.base_failed
    assert {r.doc_id: r.kept for r in found} == {None: False, 1: False, 2: False, 3: False, 4: True, 5: True, 6: True, 7: False, 8: False, 9: False, 10: False}
    assert quality_rules.quality_rules(awkward(spark).limit(0), rules).collect() == []
    assert quality_rules.rules_from(awkward(spark).limit(0), marks.limit(0)).default == 1


# Merkle manifest.


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves, fanout):
    """Root, and of each leaf the (left, right) siblings of every level."""
    proofs, level, place = [[] for _ in leaves], leaves, list(range(len(leaves)))
    while len(level) > 1:
        for k, at in enumerate(place):
            run = level[at // fanout * fanout :][:fanout]
            proofs[k].append(("".join(run[: at % fanout]), "".join(run[at % fanout + 1 :])))
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
        place = [at // fanout for at in place]
    return level[0], proofs


def manifest(rows, fanout=3):
    """rows of (doc_id, source, lang, n_chars, text): (doc_id, leaf, subroot, root, proof), in no order."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append((r[0] is not None, r[0] or 0, leaf_of(r), r[0]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s])], fanout) for s in names}
    root, above = tree([trees[s][0] for s in names], fanout)
    return sorted((str(x[3]), x[2], trees[s][0], root, tuple(trees[s][1][k] + above[names.index(s)])) for s in names for k, x in enumerate(sorted(by[s])))


def stored_rows(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, at int")


@pytest.mark.parametrize(("fanout", "levels"), [(3, 5), (3, 1), (2, 2), (4, 2)])
def test_manifest_equals_a_plain_tree(spark, fanout, levels):
    rng = np.random.default_rng(fanout * 10 + levels)
    sizes = {"b": 1, "a": 3, "ü": 4, "Z": 37, None: 10, "": 2, "hot": 300}
    rows = [(int(rng.integers(0, 10**6)), s, None if k % 5 == 0 else "en", None if k % 7 == 0 else k, [None, "", "é漢\n1:x", prose(k, 5)][k % 4]) for s, n in sizes.items() for k in range(n)]
    rows += [(None, "a", None, None, None), (5, "a", "x", 1, "one"), (5, "a", "x", 1, "two"), (5, "a", "x", 1, "one"), (None, None, None, None, "t")]
    found = merkle.merkle_manifest(stored_rows(spark, rows), fanout=fanout, levels=levels)
    folded = found.withColumn("folded", merkle.folded(F.col("leaf"), F.col("proof"))).withColumn("sum", merkle.proof_digest(F.col("proof"))).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.proof)) for r in folded) == manifest(rows, fanout)
    for r in folded:
        assert r.folded == r.root
        assert r.sum == sha("".join(s.left + s.right for s in r.proof))


def test_tampering_shows(spark):
    rows = [(k, "s", "en", 1, f"a\nb{k}" if k % 2 else f"ab{k}") for k in range(30)]
    found = merkle.merkle_manifest(stored_rows(spark, rows), other=F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    for r in found.withColumn("folded", merkle.folded(F.coalesce("other_leaf", "leaf"), F.col("proof"))).collect():
        assert (r.folded == r.root) == (r.doc_id % 2 == 0)
        assert (r.other_leaf is None) == (r.doc_id % 2 == 0)


def test_manifest_of_few_rows(spark):
    one = (3, None, None, None, None)
    found = merkle.merkle_manifest(stored_rows(spark, [one])).first()
    assert (found.leaf, found.subroot, found.root, found.proof) == (leaf_of(one),) * 3 + ([],)
    assert merkle.merkle_manifest(stored_rows(spark, [])).collect() == []
    # All rows alike: each is a leaf of its own.
    assert [len(merkle.merkle_manifest(stored_rows(spark, [one] * n)).collect()) for n in (4, 250)] == [4, 250]
