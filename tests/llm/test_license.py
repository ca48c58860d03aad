"""Files with several licences, and licences in long files."""

from cellstrata.llm import license

FULL = {label: words for label, words, _ in license.TEMPLATES}


def test_a_label_does_not_depend_on_the_rest_of_the_file(spark):
    sets = [("mit-text", "apache-2.0"), ("bsd", "apache-2.0"), ("mit-text", "gpl-3.0"), ("mit-text", "mpl-2.0", "apache-2.0", "gpl-3.0", "lgpl"), tuple(FULL)]
    rows = [(k, " and then ".join(FULL[x] for x in s)) for k, s in enumerate(sets)]
    rows.append((9, f"{' '.join(' '.join(FULL.values()).split()[::-1])} far away {FULL['apache-2.0']}"))
    got = {r.doc_id: set(r.labels.split(",")) for r in license.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, s in enumerate(sets):
        assert set(s) <= got[k]
    assert "apache-2.0" in got[9]
