"""Relations between tables found from their values."""

from quern.operators import quality


def test_relations_found_against_brute_force(spark):
    long = "x" * 200
    tables = {
        "a": ([(1, "p", 1.0), (2, "q", 2.0), (3, None, 3.0), (3, long, 1.0)], "k int, s string, v double"),
        "b": ([(1, "p", 5), (2, "q", None), (3, long, 6), (4, long + "y", 7)], "k long, value string, code short"),
        "c": ([(None, ""), (None, "1")], "none int, t string"),
        "d": ([], "k int, s string"),
        "e": ([(1.0,)], "only_numbers double"),
    }
    frames = {t: spark.createDataFrame(rows, schema) for t, (rows, schema) in tables.items()}
    got = {tuple(r) for r in quality.find_relationships(frames).collect()}
    values, rows_of = {}, {}
    for t, (rows, schema) in tables.items():
        for i, part in enumerate(schema.split(", ")):
            name, kind = part.split()
            if kind != "double":
                kind = "string" if kind == "string" else "int"
                values[(t, name, kind)] = {r[i] for r in rows if r[i] is not None}
                rows_of[t] = len(rows)
    want = {
        (a[0], a[1], b[0], b[1], len(values[a]), len(values[b]) == rows_of[b[0]])
        for a in values for b in values
        if a != b and a[2] == b[2] and values[a] and values[a] <= values[b]
    }
    assert got == want
    assert ("a", "k", "b", "k", 3, True) in got and ("a", "s", "b", "value", 3, True) in got
    assert quality.find_relationships({"e": frames["e"]}).count() == 0
