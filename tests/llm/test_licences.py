import pytest
from llm_cases import EDGE_ROWS, documents, prose, table

from tablehaul.llm import licences, queries

LINES = {
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Released under the MIT License.": "mit",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "Licensed under the Apache License, Version 2.0.": "apache",
}


@pytest.fixture(scope="module")
def classifier(spark):
    return licences.train(table(spark, "documents", "/root/testdata/sf0.01"))


def test_query_finds_every_licence_line(spark):
    """All documents that hold a licence line, by string search, and no others."""
    got = {r.doc_id: r.families for r in queries.op2_licence_classifier(spark, "/root/testdata/sf0.01").collect()}
    want = {
        r.doc_id: sorted({f for line, f in LINES.items() if line in r.text.split("\n")})
        for r in table(spark, "documents", "/root/testdata/sf0.01").collect()
    }
    assert sum(map(bool, want.values())) > 10
    assert got == want


def test_held_out_wordings(spark, classifier):
    """Sentences that are in no training list."""
    rows = [
        (1, "You can use this dataset freely, it is under the MIT License now.", ["mit"]),
        (2, "All scripts are made available to you under the Apache License, Version 2.0 since 2012.", ["apache"]),
        (3, "Text and pictures: CC BY-SA 4.0 unless noted otherwise", ["cc-by-sa"]),
        (4, "The package comes under the GNU Lesser General Public License, version 3 or newer.", ["lgpl"]),
        (5, prose(1, 4000) + " it is licensed under the Mozilla Public License, version 2.0 and " + prose(2, 300), ["mpl"]),
        (6, "Nothing here\n" + prose(4, 50) + "\nLicence: CC0 1.0 Universal\n" + prose(5, 500) + "\nGNU GPL v3", ["cc0", "gpl"]),
        (7, "The driving licence was under the table.", []),
        (8, "A university press release about public opinion and the commons.", []),
        (9, prose(8, 3000), []),
        (10, "Licensed under the Frobnicate Terms, see elsewhere.", []),
    ]
    got = {r.doc_id: r.families for r in licences.document_licences(documents(spark, [r[:2] for r in rows]), classifier).collect()}
    assert got == {i: families for i, _, families in rows}


def test_calibration(classifier):
    """Held-out wordings and licences decide the threshold, and confidence is about the share that is right."""
    assert licences.THRESHOLDS[0] < classifier.threshold < 1 and classifier.temperature in licences.TEMPERATURES
    assert classifier.precision >= 0.95 and classifier.recall >= 0.85 and classifier.calibration_error <= 0.1
    assert classifier.unknown_kept >= 0.6


# Whole licences that no list of the module has, as files hold them.
UNSEEN = """Permission to use, copy, modify, distribute, and sell this software and its
documentation for any purpose is hereby granted without fee, provided that
the above copyright notice appear in all copies and that both that
copyright notice and this permission notice appear in supporting
documentation.

In no event shall the university be liable to any party for direct, indirect,
special, incidental, or consequential damages, including lost profits, arising
out of the use of this software and its documentation.

The university specifically disclaims any warranties, including, but not
limited to, the implied warranties of merchantability and fitness for a
particular purpose. The software provided hereunder is on an "as is" basis.

Except as contained in this notice, the name of a copyright holder shall not
be used in advertising or otherwise to promote the sale, use or other dealings
in this Software without prior written authorization of the copyright holder."""


def wrapped(paragraph, width=10, comment=""):
    words = paragraph.split()
    return "\n".join(comment + " ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_whole_licences(spark, classifier):
    """Every paragraph of a whole licence is its family, or unknown where families share it; wrapped and commented lines too."""
    rows, want = [], {}
    for n, (family, paragraphs) in enumerate(licences.PARAGRAPHS.items()):
        rows.append((n, "\n\n".join(wrapped(p, 7 + n % 5, ["", "# ", " * "][n % 3]) for p in paragraphs)))
        want[n] = (family, len(paragraphs))
    rows.append((99, UNSEEN))
    got = {r.doc_id: r for r in licences.document_licences(documents(spark, rows), classifier).collect()}
    for n, (family, size) in want.items():
        assert got[n].n_paragraphs == size == got[n].n_licensed + got[n].n_unknown, (family, got[n])
        assert family in got[n].families, (family, got[n])
    assert got[99].n_paragraphs == 4 and got[99].n_licensed + got[99].n_unknown == 4, got[99]


def test_wrapped_grant_and_denials(spark, classifier):
    rows = [
        (1, wrapped(licences.PARAGRAPHS["mit"][0], 12)),
        (2, "This program is not released under the MIT License, it is proprietary."),
        (3, wrapped(prose(3, 200)) + "\nReleased under the MIT License.\n" + wrapped(prose(4, 200))),
    ]
    got = {r.doc_id: r for r in licences.document_licences(documents(spark, rows), classifier).collect()}
    assert got[1].families == ["mit"] and got[1].n_paragraphs == 1
    assert got[2].families == [] and got[2].n_unknown == 1
    assert got[3].families == ["mit"]


def test_segments_cover_all_words(spark):
    rows = [(1, prose(1, 500)), (2, "a b\n \n c\nd"), (3, None), (4, " ")]
    found = licences.segments(documents(spark, rows), size=10, overlap=4).collect()
    for doc_id, text in rows[:1]:
        own = [r.words for r in found if r.doc_id == doc_id]
        words = text.split()
        runs = [tuple(words[i : i + 4]) for i in range(len(words) - 3)]
        inside = {tuple(s[i : i + 4]) for s in own for i in range(len(s) - 3)}
        assert set(runs) == inside and max(map(len, own)) == 10
    assert [(r.paragraph, r.words) for r in found if r.doc_id == 2] == [(0, ["a", "b"]), (1, ["c", "d"])]
    assert not [r for r in found if r.doc_id in (3, 4)]


def test_edge_rows(spark, classifier):
    docs = documents(spark, [*EDGE_ROWS, (50, "MIT License"), (50, "MIT License")], "words string, families int, paragraph int")
    got = licences.document_licences(docs, classifier).collect()
    assert len(got) == len(EDGE_ROWS) + 2
    assert [r.families for r in got if r.doc_id == 50] == [["mit"]] * 2
    assert not any(r.families for r in got if r.doc_id != 50)
    assert licences.document_licences(docs.limit(0), classifier).count() == 0


def test_training_on_an_empty_table(spark):
    docs = documents(spark, EDGE_ROWS).limit(0)
    assert licences.document_licences(docs, licences.train(docs)).count() == 0


def test_plan_is_native(spark, classifier):
    plan = licences.document_licences(table(spark, "documents"), classifier)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_sample_holds_different_texts_and_no_templates(spark):
    """Many copies of one text take one place, and licence lines without a licence word are not class none."""
    footers = ["Published under CC0 1.0 Universal", "Available under CC BY 4.0"]
    rows = [(i, "the same words again") for i in range(50)] + [(100 + i, f"{prose(i, 30)}\n\n{footers[i % 2]}") for i in range(9)]
    got = [" ".join(r.words) for r in licences.ordinary_segments(documents(spark, rows), sample_documents=10).collect()]
    assert sorted(got) == sorted(["the same words again", *(prose(i, 30).lower() for i in range(9))])


def test_features_are_not_cut(classifier):
    """The number of features was once cut for memory only."""
    assert classifier.n_features == licences.FEATURES == 32_768 == classifier.model.numFeatures
