"""Terms that disclose entities whose values are unique to a text."""

import random

from tidemark.llm.sanitise import sanitise


def _marked(text, row):
    spans = [span.split(":") for span in row.spans.split(",") if span]
    return {text[int(start) : int(end)] for kind, start, end in spans if kind == "term"}


def test_unique_values_are_disclosed_by_their_group_over_the_whole_text(spark):
    filler = "alpha beta gamma delta epsilon".split()
    rng = random.Random(5)
    some = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    texts = [f"{some(9)} number {i}" for i in range(300)]
    unique = {
        "Quixbury": lambda i: f"clerk{i}@quix.example",
        "Zornheim": lambda i: f"+49 30 {1_000_000 + i}",
        "Plimsoll": lambda i: f"10.77.3.{i + 1}",
    }
    for name, value in unique.items():
        # 60 words lie between the term and the entity.
        texts += [f"{name.upper()} {some(60)} {value(i)} {some(5)}" for i in range(4)]
    texts += [f"Wexcombe {some(9)} one{i}@place{i}.example" for i in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in sanitise(docs).collect()}
    assert all(rows[i].spans == "" for i in range(300))
    for place, name in enumerate(unique):
        for i in range(300 + 4 * place, 304 + 4 * place):
            assert _marked(texts[i], rows[i]) == {name.upper()}
            assert name.upper() not in rows[i].sanitised
            assert rows[i].base_spans in rows[i].spans
    # Two texts, and no group in common: too few to tell.
    assert all(rows[i].spans == rows[i].base_spans for i in (312, 313))
