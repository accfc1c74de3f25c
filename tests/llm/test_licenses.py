from __future__ import annotations

from conftest import rows

from tarmac.llm import licenses


def test_notices(docs_of):
    texts = [
        "Some words before.\nReleased under the MIT License.\nMore words.",
        "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under CC BY-NC 4.0.",
        "My driver has a license and a warranty for the car he bought in May from a friend.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of these texts\nto deal in the texts without restriction.",
        None,
    ]
    got = rows(licenses.licenses(docs_of(*(t or "" for t in texts))), "doc_id", "template", "n_differences")
    assert got[:4] == [(0, "MIT", 0), (1, "Apache-2.0", 0), (2, "GPL-3.0", 0), (3, "CC-BY-NC-4.0", 0)]
    assert {(i, t) for i, t, _ in got[4:]} == {(5, "MIT")}


def test_places_and_differences(docs_of):
    text = "é\n\nReleased under the MIT Public License.\n"
    row = licenses.licenses(docs_of(text)).first()
    assert text[row["start"] : row["end"]] == "Released under the MIT Public License."
    assert row["differences"] == "+public"


def test_blocks_leave_nothing_out():
    """Each cue of a long paragraph lies in a window with text around it."""
    text = "license " + "word " * 2000 + "copyright\nline\n\nno cue\n\n" + "a warranty of " * 700
    paragraphs = list(licenses.paragraphs(text))
    assert len(paragraphs) == 2 and not any(whole for _, whole in paragraphs)
    for span, _ in paragraphs:
        found = [(w[0][0], w[-1][1]) for w in licenses.windows(text, span, [])]
        for cue in licenses._CUE.finditer(text, *span):
            around = max(span[0], cue.start() - 200), min(span[1] - 1, cue.end() + 200)
            assert any(a <= around[0] and around[1] <= b for a, b in found)


def planted(rng, notice, before, after, width):
    words = [f"w{rng.randrange(300)}" for _ in range(before + after)]
    words[before:before] = notice.split()
    return "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_notices_within_long_lines_and_wrapped(docs_of):
    import random

    rng = random.Random(3)
    short = {
        "MIT": "Released under the MIT License.",
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "CC-BY-4.0": "Licensed under CC BY 4.0.",
        "MPL-2.0": "subject to the terms of the Mozilla Public License, v. 2.0.",
        "AGPL-3.0": "the GNU Affero General Public License as published by the Free Software Foundation",
        "all-rights-reserved": "All rights reserved.",
    }
    wanted, texts = [], []
    for before, after, width in ((60, 0, 10_000), (0, 60, 10_000), (700, 500, 10_000), (300, 300, 9), (37, 41, 3), (900, 900, 1)):
        for name, notice in short.items():
            wanted.append((len(texts), name, notice.lower().strip(".")))
            texts.append(planted(rng, notice, before, after, width))
    got = [(r["doc_id"], r["template"], " ".join(texts[r["doc_id"]][r["start"] : r["end"]].lower().split()).strip(".")) for r in licenses.licenses(docs_of(*texts)).collect()]
    assert sorted(got) == wanted


def test_two_notices_in_one_line(docs_of):
    text = "x y z Released under the MIT License. " + "word " * 20 + "Licensed under the Apache License, Version 2.0. " + "word " * 20
    assert sorted(rows(licenses.licenses(docs_of(text)), "template")) == [("Apache-2.0",), ("MIT",)]


def test_prose_bears_none(docs_of):
    texts = [
        "The licensing office grants a license to drive, with no warranty, and a copyright lawyer may help. " * 40,
        "He took the photograph in the public domain of the city and had permission to sell it.",
    ]
    assert rows(licenses.licenses(docs_of(*texts)), "doc_id") == []
