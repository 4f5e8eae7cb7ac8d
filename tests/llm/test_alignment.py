"""Alignment of two vocabularies against a walk over the tokens of one document after another."""

import hashlib
import os
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import awkward
from tidemark.llm.alignment import Tokenizers, diagonal, pieces_of
from tidemark.llm.byte_bpe import read_ranks
from tidemark.llm.queries import aligned, op13_alignment

public = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def both():
    first = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    with open(public.path("piece_bpe_32k.model"), "rb") as file:
        bytes_of = Tokenizers(read_ranks(public.path("byte_bpe_50k.tiktoken")), public.PATTERN, file.read())
    return first, second, bytes_of


def walk(text, both):
    """``a, b, groups, links`` of a text, or None."""
    first, second, known = both
    if not text:
        return None
    whole = f" {text}".encode()
    a = first.encode(f" {text}", add_special_tokens=False).ids
    b = second.encode(text)
    if b"".join(known.bytes_a[i] for i in a) != whole or b"".join(known.bytes_b[i] for i in b) != whole:
        return None
    groups, links, i, j = [([a[0]], [b[0]])], [(a[0], b[0])], 0, 0
    end_a, end_b = len(known.bytes_a[a[0]]), len(known.bytes_b[b[0]])
    while end_a < len(whole) or end_b < len(whole):
        both_end, next_a = end_a == end_b, end_a <= end_b
        next_b = end_b <= end_a
        if both_end:
            groups.append(([], []))
        if next_a:
            i += 1
            end_a += len(known.bytes_a[a[i]])
            groups[-1][0].append(a[i])
        if next_b:
            j += 1
            end_b += len(known.bytes_b[b[j]])
            groups[-1][1].append(b[j])
        links.append((a[i], b[j]))
    return a, b, groups, links


def plain(texts, both):
    walks = [walk(text, both) for text in texts]
    counts = Counter(pair for one in walks if one for pair in set(one[3]))
    most = defaultdict(int)
    for (a, _), number in counts.items():
        most[a] = max(most[a], number)
    for one in walks:
        if one is None:
            yield (0, 0, 0, 0, 0, 0, "")
            continue
        a, b, groups, links = one
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        yield (
            len(a), len(b), len(groups), len(links),
            sum(counts[link] == most[link[0]] for link in links),
            sum(counts[link] for link in links),
            hashlib.sha256(written.encode()).hexdigest(),
        )


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_query_equals_a_walk(spark, warehouse, both):
    docs = spark.read.parquet(f"{warehouse}/documents.parquet").select("doc_id", "text").collect()
    want = [(doc_id, *row) for (doc_id, _), row in zip(docs, plain([text for _, text in docs], both))]
    assert rows_of(op13_alignment(spark, warehouse)) == sorted(want, key=str)


@pytest.mark.parametrize("work", (16, 500, 1 << 16))
def test_awkward_rows_in_pieces_of_any_size(spark, both, work):
    special = [
        (20, "a <|endoftext|> <s> </s> <unk> <0x41> ▁x  y", "en", "a", 1),
        (21, " leading and trailing \n", "en", "a", 1),
        (22, "x" * 3000, "en", "a", 1),
        (22, "x" * 3000, "en", "a", 1),
        (None, "x" * 3000, "en", "a", 1),
    ]
    rows = [row for row in [*awkward.ROWS, *special] if row[1] is None or len(row[1]) < 20_000]
    want = [(row[0], *digest) for row, digest in zip(rows, plain([row[1] for row in rows], both))]
    got = aligned(awkward.frame(spark, rows, extra=True), work=work)
    assert rows_of(got) == sorted(want, key=str)
    assert sum(row[1] == 0 for row in want) >= 4
    assert aligned(awkward.frame(spark, rows=()), work=work).collect() == []


def test_ranks_equal_the_vocabulary_on_all_characters(both):
    """A is encoded by ranks; the published tokenizer gives the same ids."""
    first, _, known = both
    for pattern in ("{0}", "a{0}b", " 1{0}2 ", "  {0}{0}  "):
        texts = [pattern.format(chr(code)) for code in range(0, 0x20000) if not 0xD800 <= code < 0xE000]
        encoded = first.encode_batch(texts, add_special_tokens=False)
        assert [one.ids for one in encoded] == [known.first.encode_ordinary(text) for text in texts]


def test_diagonals_cut_equal_pieces():
    a, b = np.array([1, 3, 3, 7]), np.array([3, 4, 8])
    merged = sorted([(end, 0) for end in a] + [(end, 1) for end in b])
    for place in range(len(merged) + 1):
        assert diagonal(a, b, place) == sum(side == 0 for _, side in merged[:place])
    pieces = list(pieces_of(a, b, a, b, 2))
    assert [piece[4] + piece[5] for piece in pieces] == [2, 2, 2, 1]
    assert sum(piece[4] for piece in pieces) == 4
