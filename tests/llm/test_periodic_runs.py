"""Periodic runs against a search through all periods of all places."""

import hashlib
import os
import random
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import awkward
from tidemark.llm.periodic_runs import Tiling, periodic_runs
from tidemark.llm.queries import op11_periodic_runs


def plain_runs(words, least=12):
    n, out = len(words), []
    for period in range(1, n // 2 + 1):
        place = 0
        while place < n - period:
            if words[place] != words[place + period]:
                place += 1
                continue
            stop = place
            while stop < n - period and words[stop] == words[stop + period]:
                stop += 1
            own = words[place : stop + period]
            shorter = (d for d in range(1, period) if period % d == 0 and own[d:] == own[:-d])
            if len(own) >= max(least, 2 * period) and next(shorter, None) is None:
                out.append((place, len(own), period))
            place = stop
    return sorted(out)


def plain_collapse(words, runs):
    gone = {place for start, length, period in runs for place in range(start + period, start + length)}
    return " ".join(word for place, word in enumerate(words) if place not in gone)


def repetitive(seed, rows=60):
    pick = random.Random(seed)
    for number in range(rows):
        words, size = [], pick.choice([0, 1, 11, 12, 13, 24, 60, 150, 300])
        letters = pick.choice([1, 2, 5, 200])
        while len(words) < size:
            block = [f"w{pick.randrange(letters)}" for _ in range(pick.randint(1, max(1, size // 3)))]
            words += block * pick.choice([1, 1, 2, 3, 7])
        yield number, "\n ".join(words[:size])


@pytest.mark.parametrize("width", (5, 7, 14))
def test_tiles_of_every_width_give_all_runs(spark, width):
    """Narrow tiles divide most documents; 2^14 words leave each in one."""
    rows = list(repetitive(width))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs(docs, Tiling(12, width)).collect()}
    some = 0
    for number, text in rows:
        words = text.split()
        runs = plain_runs(words)
        some += len(runs)
        assert [tuple(run) for run in got[number].runs] == runs
        assert got[number].n_words == len(words)
        assert got[number].collapsed == plain_collapse(words, runs)
    assert some > 30


def test_query_equals_its_definition(spark, warehouse):
    docs = spark.read.parquet(f"{warehouse}/documents.parquet").select("doc_id", "text").collect()
    got = {row.doc_id: row for row in op11_periodic_runs(spark, warehouse).collect()}
    assert len(got) == len(docs)
    planted = 0
    for doc_id, text in docs:
        words, h = (text or "").split(), zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = min(((-length, start, period) for start, length, period in runs), default=None)
        want = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        row = got[doc_id]
        assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (len(runs), *want)
        written = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row.runs_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
    assert planted


@pytest.mark.parametrize("width", (5, 14))
def test_awkward_rows(spark, width):
    # Twice the same long text, also under a null identifier: solved once, returned each time.
    repeat = "a b c d " * 400
    rows = [*awkward.ROWS, (None, repeat, "en", "a", 1), (8, repeat, "en", "a", 1)]
    runs = periodic_runs(awkward.frame(spark, rows, extra=True), Tiling(12, width)).collect()
    assert len(runs) == len(rows)
    for row in runs:
        if row.n_words == 1200:
            assert [tuple(run) for run in row.runs] == [(0, 1200, 3)]
            assert row.collapsed == "a b c d"
    assert sum(row.n_words == 1200 for row in runs) == 2
    assert sum(row.n_words == 0 and row.runs == [] and row.collapsed == "" for row in runs) == 5
    assert periodic_runs(awkward.frame(spark, rows=()), Tiling(12, width)).collect() == []


def test_a_run_needs_room_in_a_tile():
    with pytest.raises(ValueError, match="half a tile"):
        Tiling(least_run=40, width=6)
