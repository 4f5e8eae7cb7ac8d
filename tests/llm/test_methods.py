"""Each operator against a plain version of its definition."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import kneser_ney as kn
from tidemark.llm.byte_bpe import PerfectHash, decode_ids, encode_texts, merge_bytes, read_ranks
from tidemark.llm.components import connected_components
from tidemark.llm.decontaminate import Seeds, contamination
from tidemark.llm.exact_dedup import exact_groups
from tidemark.llm.jaccard_join import choose_boundary, jaccard_groups, subset_count
from tidemark.llm.license_scan import Notices, TEMPLATES, scan_licenses
from tidemark.llm.line_dedup import deduplicate_lines
from tidemark.llm.queries import QUERIES, token_digests
from tidemark.llm.rendezvous import assign_shards
from tidemark.llm.sanitise import Disclosure, sanitise
from tidemark.llm.token_rollup import TokenRollup, deletes, inserts, revisions, token_counts
from tidemark.staging import Stages, stage_path


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# --- exact groups ---


@pytest.mark.parametrize("keep", ("smallest", "largest"))
def test_exact_groups_split_a_group_of_copies(spark, keep):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot", "hot", "a", "b", "", None, "A"])) for i in range(400)]
    rows += [(7, "hot"), (7, "hot"), (None, "a"), (None, "only"), (None, "only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_groups(docs, keep=keep, salts=5).collect()
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    digest = {hashlib.sha256(text.encode()).hexdigest(): text for text in groups}
    pick = max if keep == "largest" else min
    kept = Counter()
    for row in got:
        members = groups[digest[row.text_sha256]]
        known = [m for m in members if m is not None]
        assert row.keep_id == (pick(known) if known else None)
        assert row.group_size == len(members)
        kept[row.text_sha256] += row.kept
        assert not row.kept or row.doc_id == row.keep_id
    assert set(kept.values()) == {1} and len(got) == len(rows)


# --- shards ---


def test_shards_follow_weights_and_only_a_new_shard_takes_rows(spark):
    rows = [(i, "x" * (i % 50)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = assign_shards(docs, {0: 1.0, 1: 1.0, 2: 4.0}, grown={3: 2.0}).collect()
    sizes = Counter(r.shard for r in got)
    assert sizes[2] == pytest.approx(4000, rel=0.05) and sizes[0] == pytest.approx(1000, rel=0.15)
    assert all(r.grown_shard in (r.shard, 3) for r in got)
    assert sum(r.grown_shard == 3 for r in got) == pytest.approx(1500, rel=0.1)
    for shard in sizes:
        own = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(sizes[shard]))
        assert [r.doc_id for r in own] == sorted(r.doc_id for r in own)
    text = dict(rows)
    assert all(r.size == len(text[r.doc_id]) + 16 for r in got)
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in got)


def test_a_shard_depends_on_the_identifier_alone(spark):
    one = {r.doc_id: r.shard for r in assign_shards(_docs(spark, "abc" * 50), range(9)).collect()}
    two = {r.doc_id: r.shard for r in assign_shards(_docs(spark, "xyz" * 60), range(9)).collect()}
    assert one == {doc_id: two[doc_id] for doc_id in one}


# --- personal data ---

GIVEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def _plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(GIVEN.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            right = {
                "email": lambda: True,
                "ip": lambda: all(int(part) <= 255 for part in match[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and _luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if right:
                out.append((match.start(), rank, kind, match.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(out)]


def test_base_spans_equal_the_given_patterns(spark):
    rng = random.Random(3)
    alphabets = ["a1.@-", "0123456789 -", "+1() .-9", "a@b.c_%1.2.3é🙂 ", "0.1.22.255.256 "]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "é🙂 x@y.zz +1 (706) 555-3138",
              "a" * 3_000, "1." * 3_000, "0" * 2_000 + ".1.2.3", "a@" + "b." * 20_000, "+" + "1" * 2_000]
    got = {r.doc_id: r for r in sanitise(_docs(spark, texts), with_text=False).collect()}
    for doc_id, text in enumerate(texts):
        want = _plain_spans(text)
        assert got[doc_id].base_spans == ",".join(want), text[:80]
        assert got[doc_id].n_card == sum(s.startswith("card") for s in want)


def test_terms_that_reveal_an_entity_are_marked_and_others_stay(spark):
    filler = "alpha beta gamma delta epsilon".split()
    rng = random.Random(4)
    texts = [f"{rng.choice(filler)} {rng.choice(filler)} number {i}" for i in range(300)]
    texts += [f"Doctor Quixbury says {rng.choice(filler)} call +1 706 555 3138 {'z' * (i + 1)}" for i in range(5)]
    texts += [f"alpha beta mail me@some.org {'y' * (i + 1)}" for i in range(2)]
    rows = {r.doc_id: r for r in sanitise(_docs(spark, texts), Disclosure(support=3)).collect()}
    assert all(rows[i].spans == "" and rows[i].sanitised == texts[i] for i in range(300))
    for i in range(300, 305):
        marked = [texts[i][int(s.split(":")[1]) : int(s.split(":")[2])] for s in rows[i].spans.split(",")]
        assert "Quixbury" in marked and "Doctor" in marked
        assert not set(marked) & set(filler)
        assert "Quixbury" not in rows[i].sanitised and "[phone]" in rows[i].sanitised
    # Two texts are too few to tell.
    assert all(rows[i].spans == rows[i].base_spans != "" for i in (305, 306))


# --- lines ---


def _plain_cuts(docs, min_words):
    """Every run of lines, every earlier occurrence."""
    lines, first, cuts = {}, {}, defaultdict(set)
    for doc_id, text in docs:
        pieces = re.split(r"\n(?=[^\S\n]*\S)", text, flags=re.A)
        own = [(at, piece.strip(" \t\r\n\f\v")) for at, piece in enumerate(pieces)]
        lines[doc_id] = [(at, line, len(line.split())) for at, line in own if line]
    for doc_id, own in lines.items():
        for start in range(len(own)):
            for stop in range(start + 1, len(own) + 1):
                run = own[start:stop]
                if run[-1][0] - run[0][0] != stop - start - 1:
                    break
                if sum(words for *_, words in run) < min_words:
                    continue
                place = first.setdefault(tuple(line for _, line, _ in run), (doc_id, start))
                if place != (doc_id, start):
                    cuts[doc_id].update(at for at, *_ in run)
    return cuts


@pytest.mark.parametrize("min_words", (1, 7, 12))
def test_later_copies_of_long_runs_go(spark, min_words):
    rng = random.Random(min_words)
    lines = ["a b", "c", "d e f", "g h i j", " k ", "l m", "", "  ", "n o p q r s t u"]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 16)))) for i in range(120)]
    cuts = _plain_cuts(docs, min_words)
    got = {r.doc_id: r for r in deduplicate_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_words).collect()}
    for doc_id, text in docs:
        pieces = re.split(r"\n(?=[^\S\n]*\S)", text, flags=re.A)
        assert got[doc_id].text == "\n".join(p for at, p in enumerate(pieces) if at not in cuts[doc_id])
        assert got[doc_id].n_deleted == len(cuts[doc_id])


# --- Jaccard ---


def _shingles(text, words):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def _plain_components(texts, words, percent):
    sets = [_shingles(text, words) for text in texts]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def _copies(rng, n, size):
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, max(1, size // 25))):
            words[rng.randrange(size)] = f"e{rng.randint(0, 10**6)}"
        out.append(" ".join(words[: rng.randint(size - max(1, size // 20), size)]))
    return out


@pytest.mark.parametrize(("words", "percent"), ((4, 85), (5, 80), (1, 60)))
def test_jaccard_groups_equal_all_pairs(spark, words, percent):
    rng = random.Random(words)
    texts = ["", "  ", "A b", "a  B", "a b c", "x"]
    for size in (3, 5, 9, 12, 17, 24, 40, 90, 200):
        texts += _copies(rng, 12, size)
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 14))) for _ in range(80)]
    rng.shuffle(texts)
    want = _plain_components(texts, words, percent)
    rows = jaccard_groups(_docs(spark, texts), words=words, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want


def test_the_boundary_follows_cost():
    assert subset_count(7, 85, 7) == 1 + 7
    assert choose_boundary({5: 100, 6: 100}, 50.0, 85) >= 6
    assert choose_boundary({20: 10_000}, 1.0, 85) < 20


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(5, 5)]
    with Stages(spark) as stages:
        frame = spark.createDataFrame(edges, "a long, b long")
        roots = {r.node: r.root for r in connected_components(frame, stages).collect()}
    assert roots == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}}


# --- decontamination ---


def test_passages_with_substitutions_are_found(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [" ".join(word() for _ in range(rng.choice((8, 16, 30, 60)))) for _ in range(25)]
    texts, dirty = [], set()
    for place, item in enumerate(items):
        around = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(2)]
        for changes in (0, 1):
            words = item.split()
            if changes and len(words) >= 16:
                words[len(words) // 2] = word()
            elif changes:
                continue
            dirty.add((len(texts), place))
            texts.append(f"{around[0]}, {' '.join(words).upper()}! {around[1]}")
        texts.append(" ".join(word() for _ in range(120)) + " " + " ".join(item.split()[:5]))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = contamination(_docs(spark, texts), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows if r.contaminated} == dirty
    shuffled = contamination(_docs(spark, texts), benchmark, Seeds(broadcast_rows=0)).collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, rows))
    found = next(r for r in rows if r.contaminated and len(items[r.item_id].split()) == 30)
    assert found.last_token - found.first_token == 30


# --- BPE ---


def test_bpe_equals_the_public_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    public = pytest.importorskip("public_tokenizers")
    ranks = read_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(8)
    alphabet = "abc  \n\t'sdt1239.,é漢🙂́\x85​"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) for _ in range(300)]
    texts += ["", " " * 999 + "x", "ab" * 5000, "don't we'll", "<|endoftext|>"]
    rows = {r.doc_id: r for r in decode_ids(encode_texts(_docs(spark, texts), ranks, public.PATTERN), ranks).collect()}
    for doc_id, text in enumerate(texts):
        assert rows[doc_id].ids == known.encode_ordinary(text)
        assert bytes(rows[doc_id].decoded) == text.encode()
    digest = {r.doc_id: r for r in token_digests(_docs(spark, texts)).collect()}
    for doc_id, text in enumerate(texts):
        ids = ",".join(map(str, known.encode_ordinary(text)))
        assert digest[doc_id].ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
        assert digest[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_the_perfect_hash_is_minimal_and_finds_tokens_only():
    rng = random.Random(9)
    tokens = {bytes(rng.randrange(256) for _ in range(rng.randint(1, 9))): i for i in range(5000)}
    perfect = PerfectHash(tokens)
    slots = perfect.slots(perfect.hashes(list(tokens)))
    assert sorted(slots.tolist()) == list(range(len(tokens)))
    assert perfect.find(list(tokens)) == list(tokens.values())
    strange = [key for key in (bytes([i, j, 1, 2, 3, 4, 5, 6, 7, 8]) for i in range(20) for j in range(20))]
    assert set(perfect.find(strange)) == {-1}
    assert PerfectHash({}).find([b"x"]) == [-1]


def test_merges_follow_rank_then_place():
    ranks = {b"a": 0, b"b": 1, b"ab": 3, b"ba": 2}
    assert merge_bytes(b"abab", ranks) == [0, 2, 1]
    assert merge_bytes(b"abab", {**ranks, b"aba": 4}) == [4, 1]
    assert merge_bytes(b"aab", {**ranks, b"aa": 3, b"ab": 4}) == [3, 1]
    with pytest.raises(KeyError):
        merge_bytes(b"xy", ranks)


# --- Kneser-Ney ---


def _plain_model(texts, order):
    """Interpolated modified Kneser-Ney by definition, over characters."""
    counts = Counter()
    for text in texts:
        symbols = "\n" * (order - 1) + text
        counts.update(symbols[i : i + order] for i in range(len(text)))
    tables = {order: counts}
    for size in range(order - 1, 0, -1):
        tables[size] = Counter(gram[1:] for gram in tables[size + 1])

    def discount(size):
        n = Counter(tables[size].values())
        out = {}
        for k in (1, 2, 3):
            value = None
            if n[1] + 2 * n[2] and n[k]:
                value = k - (k + 1) * n[1] / (n[1] + 2 * n[2]) * n[k + 1] / n[k]
            out[k] = value if value is not None and 0 <= value <= k else min(k / 2, 1.0)
        return out

    cuts = {size: discount(size) for size in tables}
    contexts = {size: defaultdict(list) for size in tables}
    for size, own in tables.items():
        for gram, n in own.items():
            contexts[size][gram[:-1]].append(n)

    def probability(gram):
        if not gram:
            return 1 / (len(tables[1]) + 1)
        size = len(gram)
        seen = contexts[size].get(gram[:-1])
        if not seen:
            return probability(gram[1:])
        cut = lambda n: cuts[size][min(n, 3)]
        n = tables[size].get(gram, 0)
        share = (n - cut(n)) / sum(seen) if n else 0
        return share + sum(map(cut, seen)) / sum(seen) * probability(gram[1:])

    return probability


def test_probabilities_equal_the_definition(spark):
    texts = ["The cat, the hat.\nIt's 12 o'clock!", "A bat sat on that mat", "été à la plage 🙂", "that that", "漢字 かな"]
    docs = _docs(spark, texts).withColumn("lang", F.lit("en"))
    trusted = docs.select("doc_id").filter("doc_id < 4")
    rng, symbols = random.Random(10), sorted({*"".join(texts), "Q"})
    grams = {"".join(rng.choice(symbols) for _ in range(3)) for _ in range(2000)}
    grams |= {text[i : i + 3] for text in texts for i in range(len(text) - 2)}
    wanted = spark.createDataFrame([(gram,) for gram in grams], "gram string")
    with Stages(spark) as stages:
        blocks = kn.text_blocks(docs.select("doc_id", "lang", "text"), trusted, stages)
        counted = kn.block_grams(blocks, 3, stages)
        tables = kn.count_tables(counted, 3, stages)
        got = {r.gram: (r.p0, r.p1) for r in kn.probabilities(wanted, tables, stages).collect()}
        scored = {r.doc_id: (r.symbols, r.loss) for r in kn.scores(blocks, counted, tables, stages).collect()}
    folds = {r.doc_id: r.fold for r in docs.select("doc_id", F.expr("pmod(xxhash64(text), 2) fold")).collect()}
    plain = [_plain_model([texts[i] for i in range(4) if folds[i] == fold], 3) for fold in (0, 1)]
    assert set(got) == grams
    for gram, both in got.items():
        assert both == pytest.approx([probability(gram) for probability in plain], rel=1e-9)
    for at, text in enumerate(texts):
        padded, own = "\n\n" + text, plain[1 - folds[at]]
        loss = -sum(math.log(own(padded[i : i + 3])) for i in range(len(text)))
        assert scored[at] == (len(text), pytest.approx(loss, rel=1e-9))


def test_windows_of_many_characters_and_pieces(monkeypatch):
    """More symbols than a plain base would hold, texts across pieces, empty texts among them."""
    monkeypatch.setattr(kn, "PIECE", 1000)
    rng = random.Random(3)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(9000)), "", "aé🙂", ""]
    import zstandard

    blob = zstandard.ZstdCompressor().compress("".join(texts).encode())
    symbols = np.array([len(text) for text in texts])
    windows = kn.Windows(blob, symbols, 5)
    assert windows.heads is not None
    folds = [0, 1, 1, 2]
    keys, totals = windows.counts(np.array(folds))
    got = {gram: tuple(n) for gram, n in zip(windows.strings(keys), totals.T.tolist())}
    want = defaultdict(lambda: [0, 0])
    for text, fold in zip(texts, folds):
        padded = "\n" * 4 + text
        for i in range(len(text)):
            want[padded[i : i + 5]][fold] += 1
    assert got == {gram: tuple(n) for gram, n in want.items()}
    assert windows.numbers(list(got)).tolist() == keys.tolist()


def _accepted_shares(spark, folder):
    rows = QUERIES["op10_kneser_ney"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    shares = rows.join(labels, "doc_id").groupBy("quality", "toxic").agg(
        F.avg(F.col("accepted").cast("int")).alias("share"))
    return {(r.quality, r.toxic): r.share for r in shares.collect()}


def test_junk_is_rejected_and_clean_text_kept(spark, checked_warehouse):
    shares = _accepted_shares(spark, checked_warehouse)
    assert shares[1, 0] >= 0.97 and shares[0, 0] <= 0.2 and shares[0, 1] <= 0.2


def test_toxic_text_is_rejected(spark, checked_warehouse):
    assert _accepted_shares(spark, checked_warehouse)[1, 1] <= 0.9


# --- token totals ---


def test_batches_count_once_and_signs_add_up(spark):
    rollup = TokenRollup(spark, stage_path(spark, "test-rollup"))
    assert rollup.totals().collect() == []
    docs = spark.createDataFrame(
        [(1, "a", "en", "one two 3"), (2, "a", "en", "x-y"), (3, None, None, None)],
        "doc_id long, source string, lang string, text string",
    )
    counts = token_counts(docs, "whitespace-1", "letters-1")
    total = lambda: {tuple(r) for r in rollup.totals().collect()}
    assert rollup.commit("b1", inserts(counts, "whitespace-1"))
    first = {("a", "en", "whitespace-1", 2, 4), (None, None, "whitespace-1", 1, 0)}
    assert total() == first
    assert not rollup.commit("b1", inserts(counts, "whitespace-1")) and total() == first
    assert rollup.commit("b2", revisions(counts, "whitespace-1", "letters-1"))
    assert rollup.commit("empty", inserts(counts.limit(0), "letters-1"))
    second = {("a", "en", "letters-1", 2, 4), (None, None, "letters-1", 1, 0)}
    assert total() == second
    assert rollup.compact() and total() == second
    assert not rollup.commit("b2", revisions(counts, "whitespace-1", "letters-1"))
    assert rollup.commit("b3", deletes(counts.filter("doc_id = 2"), "letters-1"))
    assert total() == {("a", "en", "letters-1", 1, 2), (None, None, "letters-1", 1, 0)}
    with pytest.raises(ValueError):
        rollup.commit("../b", inserts(counts, "letters-1"))


# --- licenses ---


def test_every_notice_is_told_from_the_others(spark):
    notices = Notices(TEMPLATES)
    for license, texts in TEMPLATES.items():
        for text in texts:
            assert notices.judge(text)[0] == license


def test_wording_decides(spark):
    gpl = TEMPLATES["GPL-3.0"][0]
    texts = [
        f"first\n{gpl}\nlast words here",
        gpl.replace("version 3", "version 7"),
        "Licensed under the  Apache license,\nversion 2.0!",
        "We talk about a license for fishing in the lake and other things",
        "nothing here",
    ]
    rows = {r.doc_id: r for r in scan_licenses(_docs(spark, texts)).collect()}
    assert (rows[0].license, rows[0].exact, rows[0].first_line, rows[0].last_line) == ("GPL-3.0", True, 1, 1)
    assert rows[1].license is None and rows[1].best_guess in ("GPL-2.0", "GPL-3.0")
    assert (rows[1].missing, rows[1].added) == (rows[1].best_guess[4], "7")
    assert (rows[2].license, rows[2].exact) == ("Apache-2.0", True)
    assert rows[3].license is None and set(rows) == {0, 1, 2, 3}
