"""The pipeline's stages against brute force on small tables."""

import corpus_pipeline
from pyspark.sql import functions as F


def five_word_sets(text):
    words = text.lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_kept(rows):
    """The least doc_id of each component of pairs that share 0.8 of their runs of five words."""
    sets = {d: five_word_sets(t) for d, t in rows}
    label = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {d: low if x == high else x for d, x in label.items()}
    return {d for d, x in label.items() if d == x}


def test_near_copies_are_counted_in_five_words(spark, rng):
    """Scattered edits give pairs on both sides of 0.8, some above it in four words and below it in five."""
    rows = []
    for group in range(6):
        base = [f"g{group}w{i}" for i in range(120)]
        rows.append((10 * group, " ".join(base)))
        for n, edits in enumerate((1, 2, 3, 5)):
            copy = list(base)
            # Far enough from each other and the ends that each edit takes a run of its own.
            for k in range(edits):
                copy[9 + 18 * k] = f"g{group}e{n}k{k}"
            rows.append((10 * group + n + 1, " ".join(copy)))
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == brute_kept(rows)


FOREIGN = [
    "Все люди рождаются свободными и равными в своем достоинстве и правах.", "Привет мир",
    "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。", "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι",
    "xkq zvwp qjjx bvkz wqpx zzkj vfgq kxjw pqzx", "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
]


def test_documents_in_no_learnt_language_go(spark, real_docs):
    """Other scripts, junk with letters and other languages go; every document of the table with a letter stays."""
    import re

    clean = [tuple(r) for r in real_docs.collect()]
    odd = [(10**6 + i, t, None, "s", 1) for i, t in enumerate([*FOREIGN, "12 34 !!", ""])]
    short = [(2 * 10**6 + i, t, None, "s", 1) for i, t in enumerate(["a", "The", "Von.", "Osrañ."])]
    docs = spark.createDataFrame([*clean, *odd, *short], real_docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert kept == {r[0] for r in [*clean, *short] if re.search(r"[^\W\d_]", r[1] or "")}


def test_no_text_goes_with_a_repeated_id(spark):
    """One doc_id with several texts: each group keeps one row, whichever texts share the id."""
    one, two, three = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, one), (2, one), (2, two), (2, two), (3, two.upper()), (4, three), (4, three + " end"), (5, ""), (5, None), (5, ""), (6, three)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    ids = sorted(d for d, _ in kept)
    assert ids == [1, 2, 4, 5, 5]
    assert {(1, one), (2, two), (5, ""), (5, None)} <= set(kept) and {t for d, t in kept if d == 4} <= {three, three + " end"}


def test_without_labels_only_letterless_documents_go(spark, odd_docs):
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    got = corpus_pipeline.identify_language(spark, unlabelled, "")
    assert got.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(map(str, [None, 4, 4, 5, 7, 8, 9, 10, -3]))
