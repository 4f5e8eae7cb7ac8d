"""The pipeline against plain versions of its stages, on whole small tables."""

import hashlib
import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline
from test_methods import _plain_components, _plain_cuts
from tidemark.llm.kneser_ney import quality_scores


def _words(text):
    return " " + " ".join(re.findall(r"[^\W_]+", text.lower())) + " "


def test_run_equals_plain_stages(spark, warehouse):
    tiktoken = pytest.importorskip("tiktoken")
    public = pytest.importorskip("public_tokenizers")
    from tidemark.llm.byte_bpe import read_ranks

    read = lambda name: spark.read.parquet(f"{warehouse}/{name}.parquet")
    # The classifier has a test of its own against its definition.
    scores = quality_scores(read("documents"), read("labels")).collect()
    accepted = {row.doc_id for row in scores if row.accepted}
    rows = read("documents").select("doc_id", "text").orderBy("doc_id").collect()
    docs = [(row.doc_id, row.text) for row in rows if row.doc_id in accepted]

    cuts, left = _plain_cuts(docs, 40), []
    for doc_id, text in docs:
        pieces = re.split(r"\n(?=[^\S\n]*\S)", text, flags=re.A)
        kept = [piece for at, piece in enumerate(pieces) if at not in cuts[doc_id]]
        if not cuts[doc_id] or any(piece.strip() for piece in kept):
            left.append((doc_id, "\n".join(kept)))

    groups = _plain_components([text for _, text in left], 5, 80)
    left = [row for place, row in enumerate(left) if groups[place][1] == place]

    items = [_words(row.text) for row in read("benchmark").collect()]
    left = [row for row in left if not any(item in _words(row[1]) for item in items)]

    ranks = read_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for doc_id, text in left:
        ids = known.encode_ordinary(text)
        written = ",".join(map(str, ids)).encode()
        want[doc_id] = (
            len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        )
    got = corpus_pipeline.run(spark, warehouse).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert 0 < len(want) < len(rows)
