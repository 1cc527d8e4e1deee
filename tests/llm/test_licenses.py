from tidemark.llm.licenses import SENTENCES, scan

MIT = (
    "The MIT License.\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software\n"
    "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including\n"
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of\n"
    "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
)


def found(df):
    return {r.doc_id: (r.licenses, r.line_ids, r.sentence_ids) for r in scan(df).collect()}


def test_rules_need_their_sentences_in_order(documents):
    use = "You may not use this file except in compliance with the License."
    grant = "Licensed under the Apache License, Version 2.0 (the \"License\");"
    copy = "You may obtain a copy of the License at"
    rows = [
        (1, "prose\nReleased under the MIT License.\nmore"), (2, MIT), (3, f"{grant}\n{use}\n{copy}:\n"), (4, f"{use}\n{grant}\n{copy}\n"),
        (5, "all   RIGHTS -- reserved"), (6, "not all rights reserved"), (7, None), (8, ""), (9, "x" * 200_000 + "\nAll rights reserved."),
        (10, f"{grant} Some words. {use} {copy}: x"), (None, "Licensed under CC BY-NC 4.0."), (1, "prose\nReleased under the MIT License.\nmore"),
    ]
    got = found(documents(rows))
    assert {k: v[0] for k, v in got.items()} == {
        1: "MIT", 2: "MIT", 3: "Apache-2.0", 4: "", 5: "All-rights-reserved", 6: "", 7: "", 8: "", 9: "All-rights-reserved",
        10: "Apache-2.0", None: "CC-BY-NC-4.0",
    }
    assert got[2][2] == "mit-title,mit-grant,mit-notice" and got[2][1] == "mit-title,mit-notice"
    assert scan(documents(rows)).count() == len(rows)
    assert scan(documents([])).count() == 0


def test_a_parameter_registry_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "Keep it. Free as air!", "x")], "doc_id bigint, text string, norm string")
    rules = {"air": [["keep", "free"]]}
    row = scan(df, sentences={"keep": "keep it", "free": "free as air"}, rules=rules).first()
    assert row.licenses == "air"


def test_sentences_are_normalised():
    import re

    for s in SENTENCES.values():
        assert s == re.sub(r"[^a-z0-9]+", " ", s.lower()).strip()


def test_no_python_in_the_plan(documents):
    plan = scan(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("EvalPython", "Pandas", "Arrow"))
