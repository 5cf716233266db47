from goldquarry.llm import licenses

SCHEMA = "doc_id long, text string"
MIT = dict(licenses.KNOWN)["MIT"]


def found(df, **kw):
    return {r.doc_id: r.license_id for r in licenses.scan_licenses(df, **kw).collect()}


def test_canonical_forms_agree(spark):
    rows = [
        (1, "Copyright (c) 2019 Some One\n\n" + MIT),
        (2, MIT.upper().replace(" ", "\n  * ")),
        (3, MIT.replace("copyright holders".upper(), "Copyright Owners")),
        (4, MIT + "\nand one more term"),
        (5, MIT[: len(MIT) // 2]),
        (6, "released under the mit licence"),
        (7, "RELEASED UNDER THE MIT LICENSE!!! (c) 2020 X"),
        (8, "licence licence"),
        (9, None),
        (10, " .,!\n"),
        (11, "(C) 2001 A\nReleased under the MIT License.\n© B. All rights reserved."),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS digest", "2 AS license_id")
    got = found(df)
    assert got == {1: "MIT", 2: "MIT", 3: "MIT", 4: None, 5: None, 6: "MIT-notice", 7: None, 8: None, 9: None, 10: None, 11: "MIT-notice"}
    digests = {r.doc_id: r.digest for r in licenses.scan_licenses(df).collect()}
    assert digests[9] is None and digests[10] is None and digests[1] == digests[2]


def test_own_list_repeats_and_empty_tables(spark):
    known = licenses.known_licenses(spark, [("b", "The Terms."), ("a", "the terms"), ("c", "?"), ("d", None)])
    df = spark.createDataFrame([(1, "THE terms"), (1, "THE terms"), (None, "the, terms"), (2, "x")], SCHEMA)
    rows = sorted((r.doc_id or 0, r.license_id) for r in licenses.scan_licenses(df, known).collect())
    assert rows == [(0, "a"), (1, "a"), (1, "a"), (2, None)]
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []


def test_known_texts_differ(spark):
    assert licenses.known_licenses(spark).count() == len(licenses.KNOWN)


def test_long_text(spark):
    rows = [(1, "word, " * 500_000), (2, "\n\n" * 100_000 + MIT)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == {1: None, 2: "MIT"}
