"""The stages of the pipeline against brute force, and on awkward tables."""

import re
from collections import Counter

from helpers import SCHEMA, docs, prose

import corpus_pipeline as pipeline
from helixframe.llm import pseudonyms


def shingles(text):
    w = text.translate({c: c + 32 for c in range(65, 91)}).encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def kept_of_copies(rows):
    """Of equal texts the longest, then the one of smallest id; a row a group."""
    groups = {}
    for i, text in rows:
        t = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i is None, i or 0, i, text))
    return Counter(min(g)[3:] for g in groups.values())


def kept_of_near_copies(rows):
    """All but those that links lead to a smaller id from."""
    root = {i: i for i, _ in rows if i is not None}
    sets = [(i, shingles(t or "")) for i, t in rows if i is not None]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return Counter((i, t) for i, t in rows if i is None or find(i) == i)


def run_stage(spark, tmp_path, name, table, k):
    out = tmp_path / f"{name}{k}"
    dict(pipeline.STAGES)[name](spark, table, str(tmp_path)).write.parquet(str(out))
    return spark.read.parquet(str(out))


def test_stages_equal_brute_force(spark, tmp_path):
    rows = [(i, prose(i, 60) + (" scum idiot" if i % 3 == 0 else "")) for i in range(90)]
    rows += [(100, prose(1, 60)), (101, prose(2, 60) + " tail"), (102, None), (103, "mail a.b1@mail.example.com or 4111 1111 1111 1111 12/26 now"), (104, prose(1, 60).replace(" ", "  ")), (105, prose(4, 59)), (106, "  "), (None, "lost words"), (None, prose(1, 60))]
    rows += [(107, prose(7, 60)), (107, prose(7, 60)), (107, prose(200, 60))]  # rows alike in id and text, and another text of that id
    table = docs(spark, rows)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(90)], "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    as_rows = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    clean = run_stage(spark, tmp_path, "toxicity", table, 1)
    assert clean.columns == table.columns and Counter(as_rows(clean)) <= Counter(rows)
    gone = Counter(rows) - Counter(as_rows(clean))
    assert len([1 for i, t in gone if t and "scum" in t]) >= 25 and not [i for i, t in gone if not t] and len(gone) <= 40
    once = run_stage(spark, tmp_path, "exact_dedup", clean, 1)
    assert Counter(as_rows(once)) == kept_of_copies(as_rows(clean)) and once.columns == table.columns
    apart = run_stage(spark, tmp_path, "ngram_jaccard", once, 1)
    assert Counter(as_rows(apart)) == kept_of_near_copies(as_rows(once)) and apart.columns == table.columns
    named = run_stage(spark, tmp_path, "pseudonyms", apart, 1)
    f = pseudonyms.Feistel(pseudonyms.session_key(spark))
    assert Counter(as_rows(named)) == Counter((i, None if t is None else pseudonyms.pseudonymised(t, f)[0]) for i, t in as_rows(apart))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in named.collect())
    assert not [t for _, t in as_rows(named) if t and ("a.b1@" in t or "4111 1111 1111 1111" in t)]
    pieces = pipeline.STAGES[-1][1](spark, named, str(tmp_path))
    assert Counter(r.doc_id for r in pieces.filter("start = 0").collect()) == Counter(i for i, _ in as_rows(named))
    assert pipeline.run(spark, str(tmp_path)).count() == pieces.count()


def test_stages_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
