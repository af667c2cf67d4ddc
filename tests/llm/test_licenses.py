from __future__ import annotations

import re

import corpus
import pytest

from basketry.llm import licenses as li

S = li.SENTENCES


def named(text):
    return [(m["license"], tuple(m["sentences"])) for m in li.match_rules(li.Catalogue().sentences(text))]


def test_every_sentence_is_found_and_hinted():
    for name, sentence in S.items():
        text = sentence.replace("{version}", "2.0")
        assert li.Catalogue().identify(text.upper() + ".")[0] == name
        assert re.search(li.HINT, text, re.IGNORECASE)


def test_every_rule_is_known_and_matches_itself():
    for name, wanted in li.RULES:
        assert set(wanted) <= set(S)
        text = ". ".join(S[w].replace("{version}", "3") for w in wanted) + "."
        assert named(text) == [(name.format("3"), wanted)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Some prose.\nReleased under the MIT License.", ["MIT"]),
        ("prose without a mark\nReleased under\n the MIT License.", ["MIT"]),
        ("# Licensed under the Apache License,\n# Version 2.0.", ["Apache-2.0"]),
        ("Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0.", ["Apache-2.0", "CC-BY-NC-4.0"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3"]),
        ("No licence at all. The license plate.", []),
        (S["mit-warranty"] + ".", ["UNKNOWN"]),
        (S["bsd-grant"] + ":\n 1. " + S["bsd-source"] + ".\n 2. " + S["bsd-binary"] + ".", ["BSD-2-Clause"]),
        (S["mit-grant"] + ":\n\n" + S["mit-notice"] + ".\n\n" + S["mit-warranty"] + ". " + S["mit-liability"] + ".", ["MIT"]),
    ],
)
def test_texts(text, expected):
    assert [x for x, _ in named(text)] == expected


def test_order_and_consumption():
    """The longer rule wins, and its sentences are not taken again; order matters."""
    full = [(w, None) for w in ("mit-grant", "mit-notice", "mit-warranty")]
    assert [m["license"] for m in li.match_rules(full)] == ["MIT"]
    assert [m["license"] for m in li.match_rules([full[0], None, *full[1:]])] == ["MIT"]
    assert [m["license"] for m in li.match_rules(full[::-1])] == ["UNKNOWN"] * 3
    assert [m["license"] for m in li.match_rules([("mit-named", None)] * 2)] == ["MIT", "MIT"]


def test_documents(spark):
    data = corpus.rows() + [
        (900, "text " * 9000 + "\nReleased under the MIT License.", "en", "a", 0),
        (901, "Released under the MIT License. Licensed under CC BY-NC 4.0. Released under the MIT License.", "en", "a", 0),
    ]
    got = li.with_names(li.license_matches(corpus.clashing(corpus.table(spark, data)))).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in data)
    found = {r["doc_id"]: (r["licenses"], r["n_matches"]) for r in got if r["n_matches"]}
    assert found == {900: ("MIT", 1), 901: ("CC-BY-NC-4.0,MIT", 3)}
    assert li.license_matches(corpus.empty(spark)).collect() == []


def layouts(wanted):
    """The sentences of a rule on one line, wrapped at every blank, and wrapped inside a comment."""
    marked = [S[w].replace("{version}", "3").replace("{holder}", "the copyright holders") for w in wanted]
    line = " ".join(x + (":" if x.endswith(("conditions", "are met")) else ".") for x in marked)
    return [line, line.replace(" ", "\n"), "# " + line.replace(" ", "\n# "), line.replace(" ", "  ")]


@pytest.mark.parametrize("name, wanted", li.RULES)
def test_layout_loses_nothing(name, wanted):
    for text in layouts(wanted):
        assert re.search(li.HINT, text, re.IGNORECASE)
        assert named(text) == [(name.format("3"), wanted)]
        assert named("A heading\n" + text) == [(name.format("3"), wanted)]
        assert named("License: " + text) == [(name.format("3"), wanted)]


def test_numbered_and_wrapped_hints(spark):
    text = S["bsd-grant"] + ": 1. " + S["bsd-source"] + ". (b) " + S["bsd-binary"] + "."
    assert [x for x, _ in named(text)] == ["BSD-2-Clause"]
    data = [(1, "This work is in the public\ndomain.", "en", "a", 0), (2, "All rights\n * reserved.", "en", "a", 0)]
    got = li.with_names(li.license_matches(corpus.table(spark, data))).collect()
    assert {r["doc_id"]: r["licenses"] for r in got} == {1: "Public-Domain", 2: "All-Rights-Reserved"}


@pytest.mark.parametrize("holder", ["Google Inc.", "the copyright holder", "J. R. Smith & Co. Ltd.", "the regents and contributors"])
def test_named_holders(holder):
    """A BSD-3 text that names its holder is not BSD-2, in any layout."""
    wanted = ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty")
    text = " ".join(S[w].replace("{holder}", holder) + "." for w in wanted)
    for layout in (text, text.replace(" ", "\n"), text.replace('"as is"', "``AS IS''")):
        assert named(layout) == [("BSD-3-Clause", wanted)]
    wanted = ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")
    assert named(". ".join(S[w].replace("{holder}", holder) for w in wanted)) == [("MIT", wanted)]
    assert [x for x, _ in named("Copyright Google Inc. All rights reserved.")] == ["All-Rights-Reserved"]
