import re

from tierflow.llm import licenses, queries


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D!-/:-@\[-`{-~]+", (text or "").lower()) if w]


def pairs(w):
    return set(zip(w, w[1:]))


def plain(texts, templates):
    """All windows of every text against all templates."""
    known = {name: words(text) for name, text in templates.items()}
    classes = licenses._classes([len(w) for w in known.values() if len(w) > 1])
    found = set()
    for doc, text in texts.items():
        w = words(text)
        for name, t in known.items():
            if len(t) < 2:
                continue
            own = next(c for c in classes if c.shortest <= len(t) <= c.longest)
            need = licenses.LEAST_CONTAINED * len(pairs(t))
            if any(len(pairs(t) & pairs(w[s : s + own.width])) >= need for s in range(0, max(1, len(w) - 1), own.stride)):
                found.add((doc, name))
    return found


def test_query_equals_all_windows(spark):
    directory = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{directory}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_licenses"](spark, directory).collect()
    assert {(r.doc_id, r.license) for r in rows} == plain(texts, licenses.TEMPLATES) and rows


def test_edited_notices(spark):
    bsd = licenses.TEMPLATES["bsd"]
    texts = {
        1: f"before {bsd} after",
        2: bsd.replace("permitted", "allowed"),
        3: " ".join(words(bsd)[:8]),
        4: "of the in the to the " * 200 + licenses.TEMPLATES["mpl-2.0"] + " of the" * 300,
        5: "all RIGHTS\nreserved!",
        6: "released under an MIT license",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = licenses.license_matches(docs).collect()
    assert {(r.doc_id, r.license) for r in rows} == plain(texts, licenses.TEMPLATES)
    of = {r.doc_id: r for r in rows}
    assert set(of) == {1, 2, 4, 5}
    assert of[1].contained == 1.0 and of[2].contained < 1.0 and of[5].license == "all-rights-reserved"


def test_whole_and_edited_license_texts(spark):
    def edited(name):
        return " ".join(w if k % 20 else "changed" for k, w in enumerate(licenses.TEMPLATES[name].split()))

    names = ["mit-text", "bsd-2-clause-text", "bsd-3-clause-text", "isc-text", "unlicense-text", "apache-2.0-text"]
    names += ["apache-2.0-header", "gpl-3.0-header", "agpl-3.0-header", "gpl-3.0-text", "lgpl-2.1-text", "mpl-2.0-text"]
    filler = "some words of another kind " * 150
    texts = {k: f"{filler}{licenses.TEMPLATES[n]} {filler}" for k, n in enumerate(names)}
    texts |= {100 + k: f"{filler}{edited(n)} {filler}" for k, n in enumerate(names)}
    texts[200] = licenses.TEMPLATES["gpl-3.0-text"][: len(licenses.TEMPLATES["gpl-3.0-text"]) // 2]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    found = {(r.doc_id, r.license): r.contained for r in licenses.license_matches(docs).collect()}
    for k, name in enumerate(names):
        assert found[k, name] == 1.0 and 0.75 <= found[100 + k, name] < 1.0
    assert (200, "gpl-3.0-text") not in found
    assert found.keys() == plain(texts, licenses.TEMPLATES)


def test_band_settings_reach_the_chance_that_is_asked_for():
    for shortest, longest in ((3, 3), (5, 7), (17, 21), (100, 140)):
        w = licenses.Windows(shortest, longest)
        assert (1 - w.least_jaccard**licenses.BAND_ROWS) ** w.bands <= licenses.MOST_MISSED
        assert w.width >= longest + w.stride - 1  # an occurrence at any place lies in one window


def test_plan_has_no_python(spark, documents):
    plan = licenses.license_matches(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edge_cases(spark, edge_docs, no_docs):
    docs = edge_docs.unionByName(edge_docs.sparkSession.createDataFrame([(20, "All rights reserved")] * 2, "doc_id long, text string"), True)
    assert sorted((r.doc_id, r.license) for r in licenses.license_matches(docs).collect()) == [(20, "all-rights-reserved")] * 2
    templates = spark.createDataFrame([("one", "word"), ("none", None), ("a", "alpha beta gamma delta"), ("a", "alpha beta gamma delta")], "license string, notice string")
    rows = licenses.license_matches(edge_docs, templates).collect()
    assert sorted(r.doc_id for r in rows) == [1, 2, 3, 4] and {r.license for r in rows} == {"a"}
    assert licenses.license_matches(no_docs).count() == 0
    assert licenses.license_matches(edge_docs, templates.limit(0)).count() == 0


def test_parts_of_templates_give_the_same_rows(spark, monkeypatch):
    notices = [(f"n{k}", f"notice number {k} of the kind w{k}") for k in range(6)]
    templates = spark.createDataFrame(notices, "license string, notice string")
    docs = spark.createDataFrame([(k, f"start {n} end") for k, (_, n) in enumerate(notices)], "doc_id long, text string")
    whole = sorted(licenses.license_matches(docs, templates).collect())
    monkeypatch.setattr(licenses, "PART_WORDS", 14)
    assert len(list(licenses._parts(templates, "license", "notice"))) == 3
    assert whole and sorted(licenses.license_matches(docs, templates).collect()) == whole
