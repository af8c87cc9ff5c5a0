import pytest

from tabscope.operators.profile import missing_summary
from tabscope.operators.inspect import schema_info
from tabscope.sources import csvfile
from tests.conftest import column, keyed

SCORES = "id,name,score,city,rating\n1,Ann,92,Oslo,4.5\n2,Ben,78,Rome,\n3,Cleo,88,Oslo,3.9\n4,Dan,65,Bonn,NA\n5,Eva,95,Rome,4.8\n"


@pytest.fixture()
def write(tmp_path):
    def to(text, name="t.csv"):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return to


def types(df):
    return dict(df.dtypes)


def test_scores(spark, write):
    df = csvfile.read_csv(spark, write(SCORES))
    assert types(df) == {"id": "bigint", "name": "string", "score": "bigint", "city": "string", "rating": "double"}
    assert keyed(schema_info(df), "column", "non_null_rate")["rating"] == 0.6
    assert keyed(schema_info(df), "column", "unique_count")["rating"] == 3
    assert keyed(missing_summary(df), "column", "null_pct")["rating"] == 40.0
    assert df.where("score > 85").count() == 3


def test_typing_rules(spark, write):
    text = (
        "whole,gap,real,truth,truth_gap,day,none,mixed\n"
        "1,1,1.5,True,True,2024-09-01,,1\n"
        "-2,,2e3,False,,2024-09-02,NA,x\n"
        "+3,3,.5,true,False,2024-09-03,null,2\n"
    )
    df = csvfile.read_csv(spark, write(text))
    assert types(df) == {
        "whole": "bigint", "gap": "double", "real": "double", "truth": "boolean",
        "truth_gap": "string", "day": "string", "none": "double", "mixed": "string"}
    assert column(df, "gap") == [1.0, None, 3.0]
    assert column(df, "real") == [1.5, 2000.0, 0.5]


def test_quotes_and_line_breaks(spark, write):
    path = write('a,b\n"say ""hi"", you","x\ny"\n"NA",2\n')
    df = csvfile.read_csv(spark, path, multi_line=True)
    assert column(df, "a") == ['say "hi", you', None]
    assert column(df, "b") == ["x\ny", "2"]


def test_too_large_whole_numbers_are_real(spark, write):
    df = csvfile.read_csv(spark, write("a\n123456789012345678901\n1\n"))
    assert types(df) == {"a": "double"}


def test_given_schema(spark, write):
    df = csvfile.read_csv(spark, write(SCORES), schema="id int, name string, score double, city string, rating double")
    assert types(df)["score"] == "double" and df.where("rating is null").count() == 2


def test_empty_and_missing_files(spark, write, tmp_path):
    with pytest.raises(ValueError):
        csvfile.read_csv(spark, write(""))
    with pytest.raises(FileNotFoundError):
        csvfile.read_csv(spark, str(tmp_path / "nope.csv"))
    bare = csvfile.read_csv(spark, write("a,b\n"))
    assert bare.columns == ["a", "b"] and bare.count() == 0


def test_uneven_rows(spark, write):
    short = csvfile.read_csv(spark, write("a,b,c\n1,x,2.5\n2\n3,y,\n"))
    assert types(short) == {"a": "bigint", "b": "string", "c": "double"}
    assert [tuple(r) for r in short.orderBy("a").collect()] == [(1, "x", 2.5), (2, None, None), (3, "y", None)]
    with pytest.raises(ValueError, match="more fields"):
        csvfile.read_csv(spark, write("a,b\n1,2\n3,4,5\n", "long.csv"))


def test_folder_of_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(f"a,b\n{i},{i}.5\n")
    df = csvfile.read_csv(spark, str(tmp_path))
    assert types(df) == {"a": "bigint", "b": "double"} and sorted(column(df, "b")) == [0.5, 1.5, 2.5]


def test_normalize_nan(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, k int")
    assert column(csvfile.normalize_nan(df), "x") == [None, 2.0]


def test_views(spark, write):
    df = csvfile.read_csv(spark, write(SCORES))
    names = csvfile.register_views(df, "scores", "id", 2)
    assert sorted(names) == [f"scores_{s}" for s in ("info", "missing", "profile", "sample", "schema", "top")]
    assert spark.table("scores_info").first()["row_count"] == 5
    assert spark.table("scores_sample").count() == 2
    assert "scores2_profile" not in csvfile.register_views(df.select("name"), "scores2", "name")


def test_lines(spark, write):
    """Lines in a column as the same lines in a file."""
    body = ['1,"say ""hi"", you",2.5,x', '2,"a\nb",NA,y', "", "  ", "3", '4,"",1e3,', '5,plain,"7",z']
    names = ["id", "a note", "n", "t"]
    df = csvfile.parse_lines(spark.createDataFrame([(x,) for x in [*body, None]], "value string"), names)
    file = csvfile.read_csv(spark, write("id,a note,n,t\n" + "\n".join(x for x in body if x.strip()) + "\n"), multi_line=True)
    assert df.schema == file.schema and types(df) == {"id": "bigint", "a note": "string", "n": "double", "t": "string"}
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, file.collect()), key=repr)
    with pytest.raises(ValueError, match="1 rows have more fields"):
        csvfile.parse_lines(spark.createDataFrame([("1,2",), ("1,2,3",)], "value string"), ["a", "b"])
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            csvfile.parse_lines(spark.createDataFrame([("1,2",)], "value string"), bad)
    assert csvfile.parse_lines(spark.createDataFrame([], "value string"), ["a", "b"]).count() == 0
