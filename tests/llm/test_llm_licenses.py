"""License scans against a plain reading of the same rules."""

import regex

import pytest

from millrace.llm import licenses

SCHEMA = "doc_id long, text string, license string, line int"
TEXTS = [
    None, "", "one", " \n\n", "Released under the MIT License.", "released UNDER the mit license", "intro\nLicensed under CC BY-NC 4.0.\nend",
    "Released under the MIT Licence.", "Licensed under the Apache License, Version 2.0.\nLicensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 2 or 3.", dict(licenses.TEMPLATES)["MIT"],
    "Copyright 2020\n\n" + dict(licenses.TEMPLATES)["ISC"].replace(". ", ".\n\n"), dict(licenses.TEMPLATES)["MIT"] * 40, "word " * 30_000,
    "the license the license the license the license",
]


def pairs(text):
    words = regex.sub(r"[^\p{L}\p{N}]+", " ", text.lower()).strip().split(" ")
    return set(zip(words, words[1:], strict=False))


def brute(text):
    found = []
    units = [] if text is None else [text, *text.split("\n")]
    for line, unit in enumerate(units):
        a = pairs(unit)
        scores = [(-round(2 * len(a & pairs(t)) / max(1, len(a) + len(pairs(t))), 9), name) for name, t in licenses.TEMPLATES]
        score, name = min(scores)
        if -score >= licenses.SIMILARITY:
            found.append((line, name, -score))
    return found


def test_units_match_plain_reading(spark):
    rows = [(i, t, "x", 5) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "x", 5), (None, TEXTS[4], None, None)]
    found = licenses.scan(spark.createDataFrame(rows, SCHEMA))
    got = sorted((str(r["doc_id"]), r["line"], r["license"], r["dice"]) for r in found.collect())
    assert got == sorted((str(i), *f) for i, t in [*enumerate(TEXTS), (None, TEXTS[4])] for f in brute(t))


def test_a_large_template_table_is_joined_by_shuffle(spark, monkeypatch):
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(TEXTS)], SCHEMA)
    expected = sorted(map(tuple, licenses.scan(df).collect()))
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", 3)
    assert sorted(map(tuple, licenses.scan(df).collect())) == expected


def test_size_bounds():
    assert licenses.merged_ranges([10, 12, 100], 1.5) == [(10 / 1.5, 18.0), (100 / 1.5, 150.0)]
    assert licenses.bounds(0.8) == pytest.approx(1.5)


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def wrapped(text, width=7, mark=""):
    words = text.split()
    return "\n".join(mark + " ".join(words[i : i + width]) for i in range(0, len(words), width))


CODE = "def run(items):\n    for item in items:\n        yield item * 2  # doubles\n" * 6
MIT, ISC, HEADER = (dict(licenses.TEMPLATES)[n] for n in ("MIT", "ISC", "Apache-2.0 header"))
RUN_TEXTS = [
    wrapped(MIT) + "\n\n" + CODE, CODE + wrapped(HEADER, 6, " * ") + "\n" + CODE, "A tool. It does things. Released under the MIT License. Have fun with it all.",
    "Copyright 2020 Ann\n" + wrapped(ISC, 9, "// ") + CODE, wrapped(MIT.replace("Software", "Program").replace("AUTHORS", "WRITERS")) + CODE,
    wrapped(MIT) + CODE * 3 + wrapped(MIT), wrapped(MIT, 8) + "\n" + CODE + wrapped(HEADER, 8, "# "), CODE, " ".join(MIT.split()[::3]) + CODE,
    wrapped(" ".join(MIT.split()[: len(MIT.split()) // 2])) + CODE, "this software " * 30 + wrapped(ISC) + " this software", None, "", "one",
    "word " * 20_000 + wrapped(HEADER) + " tail" * 500,
]


def all_runs(text, template):
    """The highest coefficient of any run of words, over all starts and ends that can matter."""
    words = regex.sub(r"[^\p{L}\p{N}]+", " ", (text or "").lower()).strip().split(" ")
    wanted, most = pairs(template), 0.0
    grams = list(zip(words, words[1:], strict=False))
    starts = [i for i, g in enumerate(grams) if g in wanted]
    for at, i in enumerate(starts):
        seen, common = set(), set()
        done = i
        for j in starts[at:]:
            if j - i > 3 * len(wanted):
                break
            for g in grams[done : j + 1]:
                seen.add(g)
                if g in wanted:
                    common.add(g)
            done = j + 1
            most = max(most, 2 * len(common) / (len(seen) + len(wanted)))
    return most


@pytest.mark.parametrize("broadcast_rows", [3, licenses.BROADCAST_ROWS])
def test_runs_match_a_search_over_all_runs_of_words(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", broadcast_rows)
    some = [t for t in licenses.TEMPLATES if t[0] in ("MIT", "ISC", "Apache-2.0 header", "MIT notice")]
    rows = [(i, t, "x", 5) for i, t in enumerate(RUN_TEXTS)] + [(0, RUN_TEXTS[0], "x", 5), (None, RUN_TEXTS[2], None, None)]
    table = licenses.template_table(spark, some)
    found = licenses.runs(spark.createDataFrame(rows, SCHEMA), templates=table).collect()
    got = {(r["doc_id"], r["license"]): r for r in found}
    assert len(got) == len(found)
    best = {(i, n): all_runs(t, s) for i, t in [*enumerate(RUN_TEXTS), (None, RUN_TEXTS[2])] for n, s in some}
    # a notice within the licence it belongs to is reported as that licence
    assert set(got) == {k for k, v in best.items() if v >= licenses.SIMILARITY}
    for k, r in got.items():
        words = regex.sub(r"[^\p{L}\p{N}]+", " ", dict(enumerate([*RUN_TEXTS])).get(k[0], RUN_TEXTS[2]).lower()).strip().split(" ")
        own = set(zip(words[r["first_word"] - 1 :][: r["n_words"]], words[r["first_word"] :][: r["n_words"] - 1], strict=False))
        template = pairs(dict(some)[k[1]])
        assert r["dice"] == pytest.approx(2 * len(own & template) / (len(own) + len(template)), abs=1e-6) and r["dice"] >= best[k] - 0.05


def test_runs_are_reported_where_no_unit_matches(spark):
    other = " ".join(f"w{i}" for i in range(600))
    rows = [(0, RUN_TEXTS[0] + other), (1, "intro\nReleased under the MIT License.\nend"), (2, RUN_TEXTS[2]), (3, "word")]
    found = licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["license"], r["line"]) for r in found} == {(0, "MIT", None), (1, "MIT notice", 2), (2, "MIT notice", None)}
    assert licenses.licenses(spark.createDataFrame([], SCHEMA)).collect() == []
