"""License notices: no license passes as another, and every notice of a block is found."""

import random

import pytest

from tidemark.llm.license_scan import CONFIRMED, GENERIC, TEMPLATES, Match, Notice, Notices, scan_licenses, words_of

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def notices():
    return Notices(TEMPLATES)


@pytest.mark.parametrize("name", ("Foo", "Commercial", "BSD", "EUPL", "Apache", "Mozilla", "GNU", "ISC Commercial"))
def test_an_unknown_license_is_none_of_the_known(notices, name):
    assert notices.judge(f"Licensed under the {name} License.")[0] is None


@pytest.mark.parametrize(
    "text, license",
    (
        ("Licensed under the Mozilla Public License, version 2.0", "MPL-2.0"),
        ("This file is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 2.", None),
        ("Licensed under CC BY-NC-SA 4.0.", None),
        ("Licensed under CC BY 3.0.", None),
        ("It is licensed under terms of the MIT license", "MIT"),
    ),
)
def test_telling_words_and_numbers(notices, text, license):
    assert notices.judge(text)[0] == license


def test_clauses_tell_licenses_apart(notices):
    three, two = TEMPLATES["BSD-3-Clause"][1], TEMPLATES["BSD-2-Clause"][1]
    assert notices.judge(three)[0] == "BSD-3-Clause" and notices.judge(two)[0] == "BSD-2-Clause"
    assert notices.judge(two)[4] and not notices.judge(two.replace("LIABLE", "GLAD"))[4]
    opening = "Redistribution and use in source and binary forms, with or without modification, are permitted."
    assert notices.judge(opening)[0] is None


def test_every_notice_of_a_block(spark):
    mit, apache = "Licensed under the MIT License.", "Licensed under the Apache License, Version 2.0."
    grant = TEMPLATES["MIT"][2]
    prose = "Some words of another kind stand here before anything of interest is said at all"
    texts = [
        f"{mit}\n{apache}",
        f"{mit} {apache} {mit}",
        f"{prose}. {apache} {prose}.",
        f"top\n{grant}\n{mit}\nend of it all",
        None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    found = {}
    for row in scan_licenses(docs).collect():
        found.setdefault(row.doc_id, []).append((row.first_line, row.last_line, row.license, row.exact))
    assert sorted(found[0]) == [(0, 0, "MIT", True), (1, 1, "Apache-2.0", True)]
    assert sorted(found[1]) == [(0, 0, "Apache-2.0", True), (0, 0, "MIT", True), (0, 0, "MIT", True)]
    assert found[2] == [(0, 0, "Apache-2.0", True)]
    assert sorted(found[3]) == [(1, 1, "MIT", True), (2, 2, "MIT", True)]
    assert 4 not in found


def _plain_confirmed(notice, words):
    """Whether any stretch of the words meets the rule, by an alignment of each."""

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for place, y in enumerate(b):
                row[place + 1] = last[place] + 1 if x == y else max(last[place + 1], row[place])
        return row[-1]

    for start in range(len(words)):
        for stop in range(start + 1, len(words) + 1):
            own = words[start:stop]
            if 2 * common(notice.words, own) < CONFIRMED * (len(notice.words) + len(own)):
                continue
            needed = [word for word in notice.words if word in notice.telling or word[0].isdigit()]
            extra = list(own)
            for word in notice.words:
                if word in extra:
                    extra.remove(word)
            if common(needed, own) == len(needed) and all(word in GENERIC for word in extra):
                return True
    return False


def test_short_notices_against_all_stretches(notices):
    pick, compared = random.Random(5), 0
    pool = ["foo", "public", "2.0", "3", "apache", "mit", "the", "license", "version", "gnu"]
    for notice in notices.entries:
        if not notice.short:
            continue
        for _ in range(25):
            words = list(notice.words)
            for _ in range(pick.randint(0, 2)):
                place = pick.randrange(len(words) + 1)
                words[place : place + pick.randint(0, 1)] = pick.choice([[], [pick.choice(pool)]])
            words = ["so", "far", *words, "and", "on"]
            if Match(notice, words).confirmed():
                compared += 1
                assert _plain_confirmed(notice, words), (notice.words, words)
            elif words[2:-2] == notice.words:
                raise AssertionError(words)
    assert compared > 50


def test_a_notice_knows_its_words():
    notice = Notice("X", "Licensed under the Foo License, version 2.0.")
    assert notice.telling == {"foo", "2.0"} and words_of("v2.0") == ["v2.0"]
