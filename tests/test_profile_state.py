import numpy as np
import pytest

from lakeq.operators import checks, profile, profile_state
from lakeq.operators.type_lattice import merge_type_states, type_state, types_of
from lakeq.sources.csv import read_csv_by_file


def texts(spark, columns):
    names = list(columns)
    return spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{n}` string" for n in names))


COLUMNS = {
    "int": ["1", "-2", "+3", " 4 ", "5", "6"],
    "gap": ["1", None, "2", "3", "4", "5"],
    "num": ["1", "2.5", ".5", "1e3", "7.", "8"],
    "long": ["123456789012345678", "9223372036854775807", "1", "2", "3", "4"],
    "beyond": ["9223372036854775808", "1", "2", "3", "4", "5"],
    "bool": ["True", "false", "TRUE", "true", "False", "FALSE"],
    "mix": ["True", "1", "false", "2", "x", None],
    "none": [None] * 6,
    "tab": ["\t1", "2", "3\n", "4", "5", "6"],
}
TYPES = {"int": "bigint", "gap": "double", "num": "double", "long": "bigint", "beyond": "string", "bool": "boolean",
         "mix": "string", "none": "double", "tab": "bigint"}


@pytest.mark.parametrize("cut", [0, 1, 3, 6])
def test_types_of_merged_parts_equal_those_of_the_whole(spark, cut):
    parts = [texts(spark, {k: v[:cut] for k, v in COLUMNS.items()}) if cut else None,
             texts(spark, {k: v[cut:] for k, v in COLUMNS.items()}) if cut < 6 else None]
    merged = types_of(merge_type_states(*[type_state(p) for p in parts if p is not None]))
    whole = types_of(type_state(texts(spark, COLUMNS)))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    assert {r.column_name: r.inferred_type for r in merged.collect()} == TYPES


def test_a_column_of_two_types_is_text(spark):
    a = spark.createDataFrame([(1, "1")], "x int, y string")
    b = spark.createDataFrame([("1", "2")], "x string, y string")
    got = {r.column_name: r.inferred_type for r in types_of(merge_type_states(type_state(a), type_state(b))).collect()}
    assert got == {"x": "string", "y": "bigint"}


def test_profile_of_merged_runs(spark, tmp_dir):
    rng = np.random.default_rng(3)
    rows = [(str(int(rng.integers(0, 50))), None if i % 9 == 0 else f"{rng.normal(100, 20):.6f}", float("nan") if i % 7 == 0 else float(i))
            for i in range(6000)]
    schema = "few string, many string, d double"
    states, values = [], []
    for k in range(3):
        run = profile.without_nan(spark.createDataFrame(rows[k::3], schema))
        state = profile_state.run_state(run, f"r{k}")
        state.write.parquet(f"{tmp_dir}/state{k}")
        state = spark.read.parquet(f"{tmp_dir}/state{k}")
        states.append(state)
        values.append(profile_state.run_values(run, state, f"r{k}"))
    every = profile_state.union_states(*states)
    merged = profile_state.merge_states(every)
    got = {r.column_name: r for r in profile_state.profile_of(
        merged, profile_state.merge_values(every, profile_state.union_states(*values))).collect()}
    few = [r[0] for r in rows]
    assert got["few"].distinct_values == len(set(few)) and got["few"].most_frequent_count == max(few.count(x) for x in set(few))
    assert got["many"].distinct_values is None and got["d"].distinct_values is None
    many = np.array([float(r[1]) for r in rows if r[1]])
    assert abs(got["many"].distinct_estimate - len(set(many))) < 0.03 * len(many)
    assert (got["many"].total_rows, got["many"].missing_count, got["d"].missing_count) == (6000, 667, 858)
    for q, name in ((0.25, "q1_estimate"), (0.5, "median_estimate"), (0.75, "q3_estimate")):
        assert abs((many <= got["many"][name]).mean() - q) < 0.02
    assert (got["many"].min_number, got["many"].max_number) == (many.min(), many.max())


def test_empty_run_keeps_the_profile(spark):
    full = spark.createDataFrame([("1",), ("2",), (None,)], "x string")
    none = full.limit(0)
    states = profile_state.union_states(profile_state.run_state(full, "a"), profile_state.run_state(none, "b"))
    values = profile_state.union_states(profile_state.run_values(full, profile_state.run_state(full, "a"), "a"),
                                        profile_state.run_values(none, profile_state.run_state(none, "b"), "b"))
    row = profile_state.profile_of(profile_state.merge_states(states), profile_state.merge_values(states, values)).first()
    assert (row.runs, row.total_rows, row.missing_count, row.distinct_values, row.max_number) == (2, 3, 1, 2, 2.0)


def test_each_file_is_decoded_by_its_own_encoding(spark, tmp_dir):
    files = {"a.csv": "id,t\n1,café Ω\n2,x\n".encode(), "b.csv": "id,t\n3,café €\n4,y\n".encode("cp1252"),
             "c.csv": b"id,t\n5,caf\xe9 \x81\n", "d.csv": b"id,t\n6,plain\n"}
    for name, data in files.items():
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(data)
    got = {r.id: (r.t, r.source_encoding, r.source_file.rsplit("/", 1)[1]) for r in read_csv_by_file(spark, tmp_dir).collect()}
    assert got == {"1": ("café Ω", "utf-8", "a.csv"), "2": ("x", "utf-8", "a.csv"), "3": ("café €", "cp1252", "b.csv"),
                   "4": ("y", "cp1252", "b.csv"), "5": ("café \x81", "latin1", "c.csv"), "6": ("plain", "utf-8", "d.csv")}
    strict = {r.id: (r.t, r.source_encoding) for r in read_csv_by_file(spark, tmp_dir, ("utf-8", "cp1252")).collect()}
    assert strict[None] == (None, None) and strict["3"] == ("café €", "cp1252")
    with pytest.raises(ValueError, match="utf-7"):
        read_csv_by_file(spark, tmp_dir, ("utf-7",))


def test_date_gaps(spark):
    days = ["2024-01-30", "2024-02-02", "2024-02-02", "2024-05-01", None, "2024-05-02"]
    df = spark.createDataFrame([(d, "g") for d in days] + [("2024-03-01", "h")], "day string, grp string").where("grp = 'g' or day is not null")
    by = sorted((r.grp, str(r.gap_from), str(r.gap_to), r.gap_days) for r in checks.date_gaps(df, "day", by=["grp"]).collect())
    assert by == [("g", "2024-01-31", "2024-02-01", 2), ("g", "2024-02-03", "2024-04-30", 88)]
    whole = sorted((str(r.gap_from), r.gap_days) for r in checks.date_gaps(df, "day").collect())
    assert whole == [("2024-01-31", 2), ("2024-02-03", 27), ("2024-03-02", 60)]
    assert checks.missing_dates(df, "day").count() == 89
