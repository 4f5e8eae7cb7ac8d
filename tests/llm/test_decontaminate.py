"""Overlaps by definition: every allowed pattern of changes, items of every length."""

import random
from itertools import combinations

from tidemark.llm.decontaminate import Seeds, clean_documents, contamination, finds_all, mask_of


def test_masks_lose_no_allowed_pattern():
    seeds = Seeds()
    for length in range(1, seeds.window + 1):
        needed = -(-length * seeds.percent // 100) if length >= seeds.least else length
        assert finds_all(mask_of(seeds, length), length, length - needed)
    assert not finds_all("110110101101", 16, 3)


def test_all_substitutions_of_an_item_are_found(spark):
    texts, items = [], []
    for length in (6, 7, 10, 12, 13, 15, 16):
        item = [f"i{length}x{place}" for place in range(length)]
        items.append(" ".join(item))
        changes = length - -(-length * 80 // 100)
        for changed in combinations(range(length), changes):
            words = [f"c{place}" if place in changed else word for place, word in enumerate(item)]
            texts.append((len(texts), f"before {' '.join(words)} after", len(items) - 1, length - changes))
    docs = spark.createDataFrame([row[:2] for row in texts], "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {r.doc_id: (r.item_id, r.agreeing) for r in contamination(docs, benchmark).collect()}
    assert found == {row[0]: (row[2], row[3]) for row in texts}


def _plain(text, item, seeds):
    """Most agreeing tokens of one overlap, or None."""
    doc, item = text.split(), item.split()
    width = min(seeds.window, len(item))
    percent = seeds.percent if len(item) >= seeds.least else 100
    best = max(
        (
            sum(
                0 <= p + shift < len(doc) and doc[p + shift] == item[p]
                for p in range(begin, begin + width)
            )
            for begin in range(len(item) - width + 1)
            for shift in range(-len(item), len(doc))
        ),
        default=0,
    )
    return best if item and 100 * best >= percent * width else None


def test_overlaps_equal_the_definition(spark):
    rng = random.Random(14)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3)
    items = [" ".join(word() for _ in range(length)) for length in (0, 1, 2, 3, 5, 6, 9, 10, 11, 15, 16, 24, 40)]
    texts = []
    for _ in range(150):
        words = rng.choice(items).split()
        words = words[rng.randint(0, len(words) // 3) :]
        words = [word() if rng.random() < 0.15 else one for one in words]
        around = [[word() for _ in range(rng.randint(0, 3))] for _ in range(2)]
        texts.append(" ".join([*around[0], *words, *around[1]]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for seeds in (Seeds(), Seeds(window=10, percent=70)):
        rows = {r.doc_id: r for r in contamination(docs, benchmark, seeds).collect()}
        for doc_id, text in enumerate(texts):
            best = {place: _plain(text, item, seeds) for place, item in enumerate(items)}
            best = {place: agreeing for place, agreeing in best.items() if agreeing is not None}
            row = rows[doc_id]
            assert row.n_items == len(best), (text, best)
            if best:
                first = min(best, key=lambda place: (-best[place], place))
                assert (row.item_id, row.agreeing) == (first, best[first])


def test_items_without_or_with_the_same_identifier(spark):
    """A null or repeated identifier hides no item."""
    first = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    second = " ".join(reversed(first.split()))
    third = first.replace("t", "q")
    items = spark.createDataFrame([(None, first), (7, second), (7, third), (7, third)], "item_id long, text string")
    docs = spark.createDataFrame(
        list(enumerate([f"x {first} y", f"{second} z", f"{third}", f"{first} {second}", "none of it"])),
        "doc_id long, text string",
    )
    rows = {r.doc_id: r for r in contamination(docs, items).collect()}
    assert [rows[n].contaminated for n in range(5)] == [True, True, True, True, False]
    assert [rows[n].n_items for n in range(5)] == [1, 1, 2, 2, 0]
    assert rows[0].item_id is None and rows[1].item_id == 7
    assert {r.doc_id for r in clean_documents(docs, items).collect()} == {4}


def test_shortest_item(spark):
    items = spark.createDataFrame([(1, "the"), (2, "the end")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "the start"), (2, "here is the end")], "doc_id long, text string")
    assert {r.doc_id for r in contamination(docs, items).filter("contaminated").collect()} == {1, 2}
    assert {r.doc_id for r in contamination(docs, items, Seeds(shortest=2)).filter("contaminated").collect()} == {2}
    assert contamination(docs, items, Seeds(shortest=3)).filter("contaminated").count() == 0
