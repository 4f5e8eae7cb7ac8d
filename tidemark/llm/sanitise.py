"""Personal data: patterns, and terms that give a protected entity away.

Patterns find the protected entities (mail and network addresses, card and phone numbers).
The corpus then tells how strongly a term of the same text reveals an entity: the pointwise
mutual information of both, measured against the information content of the entity, is 1 when
the term occurs with that entity only. As most values are unique to a text, entities are also
counted by what they share (mail domain, network, issuer, number prefix). Terms beyond a
threshold are generalised, those that are next to a substitute for the entity are removed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import pick, text_or_empty
from tidemark.staging import Stages

#: In the order that breaks ties between spans with the same start.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

#: What must be in a text before its pattern is tried.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

#: The given patterns, made linear: runs are taken whole and a match begins where a run does,
#: or where the match before it ended. They find the same spans.
PATTERNS = {
    "email": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
    ),
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

SPANS = "array<struct<start:int,end:int,value:string>>"


@dataclass(frozen=True)
class Disclosure:
    """Shares of the entity's information content from which a term is generalised or removed;
    least number of different texts in which both occur; fewest letters of a term."""

    generalise: float = 0.8
    remove: float = 0.95
    support: int = 3
    letters: int = 3


def located(text: Column, pattern: str | Column) -> Column:
    """Spans of all matches, in code points: lengths of gaps and matches add up."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(
        F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("value")
    )
    start = lambda state, pair: state["at"] + F.char_length(pair["gap"])
    end = lambda state, pair: start(state, pair) + F.char_length(pair["value"])
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    return F.aggregate(
        pairs,
        empty,
        lambda state, pair: F.struct(
            end(state, pair).alias("at"),
            F.concat(
                state["spans"],
                F.array(
                    F.struct(
                        start(state, pair).alias("start"),
                        end(state, pair).alias("end"),
                        pair["value"].alias("value"),
                    )
                ),
            ).alias("spans"),
        ),
        lambda state: state["spans"],
    )


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.split(value, r"\.")
        return F.forall(parts, lambda part: F.coalesce(part.try_cast("int") <= 255, F.lit(False)))
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        right = F.char_length(digits).between(12, 19)
        return right & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    hint = HINTS[kind]
    there = text.contains(hint) if hint else text.rlike("[0-9](?:[\\x20-]?+[0-9]){11}")
    valid = F.filter(located(text, PATTERNS[kind]), lambda span: _valid(kind, span["value"]))
    return F.when(there, valid).otherwise(F.array().cast(SPANS))


def _ordered(*groups: tuple[int, str, Column]) -> Column:
    """All spans by start, then kind."""

    def ranked(rank: int, kind: str, spans: Column) -> Column:
        return F.transform(
            spans,
            lambda span: F.struct(
                span["start"].alias("start"),
                F.lit(rank).alias("rank"),
                span["end"].alias("end"),
                F.lit(kind).alias("kind"),
                span["value"].alias("value"),
            ),
        )

    return F.array_sort(F.concat(*[ranked(*group) for group in groups]))


def _written(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def find_personal_data(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, text, n_email, n_ip, n_card, n_phone, base``: row-wise, nothing is shuffled."""
    rows = pick(docs, id_column, text_column).toDF("doc_id", "text")
    found = rows.select("doc_id", text_or_empty().alias("text"))
    found = found.select("*", *[base_spans(F.col("text"), kind).alias(kind) for kind in KINDS])
    groups = [(rank, kind, F.col(kind)) for rank, kind in enumerate(KINDS)]
    return found.select(
        "doc_id",
        "text",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        _ordered(*groups).alias("base"),
    )


def _entities(spans: Column) -> Column:
    """The values, and the groups that they belong to: the domain of a mail address, the first
    two parts of a network address, the first 6 digits of a card and 4 of a phone number."""

    def levels(span: Column) -> Column:
        digits = F.regexp_replace(span["value"], "[^0-9]", "")
        number = span["kind"].isin("card", "phone")
        value = F.when(number, digits).otherwise(F.lower(span["value"]))
        group = (
            F.when(span["kind"] == "email", F.substring_index(value, "@", -1))
            .when(span["kind"] == "ip", F.substring_index(value, ".", 2))
            .when(span["kind"] == "card", F.substring(value, 1, 6))
            .otherwise(F.substring(value, 1, 4))
        )
        return F.array(
            F.concat_ws(":", span["kind"], value), F.concat_ws(":", span["kind"], F.lit("in"), group)
        )

    return F.array_distinct(F.flatten(F.transform(spans, levels)))


def _digest() -> Column:
    return F.sha2("text", 256).alias("digest")


def _masked(text: Column, spans: Column) -> Column:
    """The text with blanks instead of entities, and one more blank on each side."""
    blanks = F.aggregate(
        spans,
        text,
        lambda state, span: F.overlay(
            state,
            F.repeat(F.lit(" "), span["end"] - span["start"]),
            span["start"] + 1,
            span["end"] - span["start"],
        ),
    )
    return F.concat(F.lit(" "), blanks, F.lit(" "))


def recurring_entities(
    found: DataFrame, stages: Stages, settings: Disclosure = Disclosure()
) -> DataFrame:
    """``digest, entity, rows, n_entity``: entities, by text and in rows of it and of the table.
    Those of fewer texts than ``support`` have no pair that reaches it."""
    held = stages(
        found.filter(F.size("base") > 0)
        .select(_digest(), F.explode(_entities(F.col("base"))).alias("entity"))
        .groupBy("digest", "entity")
        .agg(F.count(F.lit(1)).alias("rows")),
        "entity-texts",
    )
    often = (
        held.groupBy("entity")
        .agg(F.sum("rows").alias("n_entity"), F.count(F.lit(1)).alias("texts"))
        .filter(F.col("texts") >= settings.support)
    )
    return held.join(often.drop("texts"), "entity")


def text_terms(found: DataFrame, settings: Disclosure = Disclosure()) -> DataFrame:
    """``digest, term``: the different words, entities left out, of the texts with entities."""
    word = rf"\p{{L}}{{{settings.letters},}}+"
    with_any = found.filter(F.size("base") > 0)
    words = F.regexp_extract_all(_masked(F.col("text"), F.col("base")), F.lit(word), F.lit(0))
    terms = F.array_distinct(F.transform(words, lambda one: F.lower(one)))
    return (
        with_any.select(_digest(), F.explode_outer(terms).alias("term"))
        .filter(F.col("term").isNotNull())
        .distinct()
    )


def disclosing_terms(
    found: DataFrame, stages: Stages, settings: Disclosure = Disclosure()
) -> DataFrame:
    """``digest, term, disclosure``: terms whose disclosure of an entity of the same text, at
    most, reaches the lower threshold.

    Probabilities are shares of rows. With n rows in all, the disclosure of entity e by
    term t is log(n n(t,e) / (n(t) n(e))) / log(n / n(e)); it counts as 1 where an entity
    is in every row. n(t) counts the rows that hold the term anywhere.
    """
    entities = stages(recurring_entities(found, stages, settings), "recurring-entities")
    pairs = stages(
        text_terms(found, settings).join(entities, "digest"), "entity-terms"
    )
    together = (
        pairs.groupBy("entity", "term", "n_entity")
        .agg(F.sum("rows").alias("n_both"), F.count(F.lit(1)).alias("texts"))
        .filter(F.col("texts") >= settings.support)
    )
    word = rf"\p{{L}}{{{settings.letters},}}+"
    # The outer form, as the other would find all words once more to drop empty arrays.
    words = found.select(
        F.explode_outer(
            F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(word), F.lit(0)))
        ).alias("term")
    )
    frequency = words.filter("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    total = found.agg(F.count(F.lit(1)).cast("double").alias("n"))
    disclosing = (
        together.join(frequency, "term")
        .withColumn("n", total.scalar())
        .withColumn("information", F.log(F.col("n") / F.col("n_entity")))
        .withColumn(
            "shared", F.log(F.col("n") * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
        )
        .withColumn(
            "disclosure",
            F.when(F.col("information") > 0, F.col("shared") / F.col("information")).otherwise(1.0),
        )
        .filter(F.col("disclosure") >= settings.generalise)
        .select("entity", "term", "disclosure")
    )
    return (
        pairs.join(disclosing, ["entity", "term"])
        .groupBy("digest", "term")
        .agg(F.max("disclosure").alias("disclosure"))
    )


def term_spans(
    found: DataFrame, disclosing: DataFrame, settings: Disclosure = Disclosure()
) -> DataFrame:
    """``digest, terms, removed``: where the disclosing terms of a text are, whole words in any
    case, and the starts of those to remove."""
    by_text = disclosing.groupBy("digest").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("told")
    )
    words = F.concat(
        F.lit(r"(?iu)(?<!\p{L})(?:"),
        F.array_join(F.array_sort(F.map_keys("told")), "|"),
        F.lit(r")(?!\p{L})"),
    )
    located_words = (
        found.filter(F.size("base") > 0)
        .select(_digest(), _masked(F.col("text"), F.col("base")).alias("masked"))
        .join(by_text, "digest")
        .select("digest", "told", located(F.col("masked"), words).alias("words"))
    )
    told = lambda span: F.try_element_at("told", F.lower(span["value"]))
    nothing = F.lit(None).cast("string")
    # The masked text has a blank before the text.
    terms = F.transform(
        F.filter("words", lambda span: told(span).isNotNull()),
        lambda span: F.struct(
            (span["start"] - 1).alias("start"), (span["end"] - 1).alias("end"), nothing.alias("value")
        ),
    )
    gone = F.filter("words", lambda span: F.coalesce(told(span) >= settings.remove, F.lit(False)))
    return (
        located_words.select(
            "digest",
            terms.alias("terms"),
            F.transform(gone, lambda span: span["start"] - 1).alias("removed"),
        )
        .groupBy("digest")
        .agg(F.first("terms").alias("terms"), F.first("removed").alias("removed"))
    )


def _sanitised(text: Column, spans: Column, removed: Column) -> Column:
    """Each span becomes its kind in brackets; removed terms vanish. Spans may overlap."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        label = F.concat(F.lit("["), span["kind"], F.lit("]"))
        gone = (span["kind"] == TERM) & F.array_contains(removed, span["start"])
        written = F.concat(
            state["out"],
            F.substring(text, state["at"] + 1, span["start"] - state["at"]),
            F.when(gone, "").otherwise(label),
        )
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(span["start"] >= state["at"], written).otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(
        spans,
        start,
        step,
        lambda state: F.concat(
            state["out"], F.substring(text, state["at"] + 1, F.char_length(text))
        ),
    )


def sanitise(
    docs: DataFrame,
    settings: Disclosure = Disclosure(),
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """One row per input row: ``doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans``
    and, ``with_text``, ``sanitised``.

    Both span columns are ``kind:start:end`` by start, then kind, joined by commas; ``spans``
    also holds the terms that disclose an entity of their text. A null text counts as empty and
    has no spans. The result of a row depends on its text and the corpus alone, so repeated
    rows and rows with a null or repeated identifier are no special case. An empty table
    gives an empty result.

    Words of texts with entities, counts of words and narrow spans are shuffled; of the texts
    only those with entities are, where the ones that hold disclosing terms are many.
    """
    spark = docs.sparkSession
    found = find_personal_data(docs, id_column, text_column)
    with Stages(spark) as stages:
        disclosing = stages(disclosing_terms(found, stages, settings), "disclosing-terms")
        terms = stages.keep(term_spans(found, disclosing, settings), "term-spans")
    keyed = found.withColumn("digest", F.when(F.size("base") > 0, F.sha2("text", 256)))
    if not with_text:
        keyed = keyed.drop("text")
    joined = keyed.join(terms, "digest", "left")
    terms_or_none = F.coalesce("terms", F.array().cast(SPANS))
    every = F.array_sort(F.concat("base", _ordered((len(KINDS), TERM, terms_or_none))))
    result = joined.select(
        "*",
        _written(F.col("base")).alias("base_spans"),
        every.alias("every"),
    )
    extra = (
        [
            _sanitised(
                F.col("text"), F.col("every"), F.coalesce("removed", F.array().cast("array<int>"))
            ).alias("sanitised")
        ]
        if with_text
        else []
    )
    return result.select(
        "doc_id",
        *[f"n_{kind}" for kind in KINDS],
        "base_spans",
        _written(F.col("every")).alias("spans"),
        *extra,
    )
