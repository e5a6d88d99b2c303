import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.config import ColumnTransformation, SpecError
from sediment.functions import lookup, protect, register, registered, text
from sediment.operators import mapping as m
from sediment.session import materialize


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("o")).first()[0]


@pytest.mark.parametrize(
    "name,value,expected",
    [
        ("trim", "  a b ", "a b"),
        ("standardize_names", " ann lee ", "ANN LEE"),
        ("proper_case", "an-na maRIE", "An-na Marie"),
        ("remove_special_chars", "O'Né-il #1!", "O'Né-il 1"),
        ("clean_phone", "+1 (555) 010-77", "+155501077"),
        ("clean_phone", "555+1", "5551"),
        ("standardize_phone", None, None),
        ("clean_address", "  1\tMain \n St ", "1 Main St"),
        ("standardize_zip", "12345", "12345"),
        ("standardize_zip", "123456789", "12345-6789"),
        ("standardize_zip", "12345-6789", "12345-6789"),
        ("standardize_zip", "501", "00501"),
        ("standardize_zip", "12", None),
        ("sha256", "a", "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"),
    ],
)
def test_named_transforms(spark, name, value, expected):
    assert one(spark, lookup(name), value) == expected


def test_email_checks(spark):
    assert one(spark, text.email_valid, "a.b+c@x-y.org") is True
    assert one(spark, text.email_valid, "a@b") is False
    assert one(spark, text.email_valid, None) is None
    assert one(spark, text.email_domain, "a@X.org") == "x.org"
    assert one(spark, text.email_domain, "nothing") is None


def test_timestamp_that_does_not_parse_is_null(spark):
    assert one(spark, text.parse_timestamp, "2024-01-02") is None
    assert one(spark, lambda c: text.parse_timestamp(c).cast("string"), "2024-01-02T03:04:05.678Z") == "2024-01-02 03:04:05.678"


def test_transform_registry():
    @register("shout")
    def shout(c):
        return F.concat(F.upper(c), F.lit("!"))

    assert "shout" in registered() and lookup("shout") is shout
    with pytest.raises(SpecError):
        lookup("no such transform")


def test_later_step_sees_earlier_target(spark):
    df = spark.createDataFrame([(2, "7", "x")], "a int, b string, c string")
    out = m.apply_transformations(
        df,
        [
            ColumnTransformation("d", "expression", expression="a * 10"),
            ColumnTransformation("e", "expression", expression="d + 1"),
            ColumnTransformation("b", "cast", "b", "int"),
            ColumnTransformation("c", "cast", "c", "int", on_error="null"),
            ColumnTransformation("f", "direct", "b"),
        ],
    )
    assert out.first().asDict() == {"a": 2, "b": 7, "c": None, "d": 20, "e": 21, "f": 7}


def test_bad_transformations_are_refused():
    with pytest.raises(SpecError):
        ColumnTransformation("x", "guess")
    with pytest.raises(SpecError):
        ColumnTransformation("x", "cast", "y")


def test_cast_without_on_error_raises(spark):
    df = spark.createDataFrame([("x",)], "v string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        m.apply_transformations(df, [ColumnTransformation("v", "cast", "v", "int")]).collect()


SPEC = {
    "source_fields": {
        "id": {"type": "string", "required": True, "validation": {"pattern": "^C[0-9]+$", "on_error": "reject"}},
        "name": {"type": "string", "required": True, "validation": {"max_length": 3, "on_error": "truncate"}},
        "phone": {"type": "string", "validation": {"pattern": "^[0-9]+$", "on_error": "null"}},
        "state": {"type": "string", "validation": {"length": 2, "case": "upper"}},
        "age": {"type": "int"},
        "zip": {"type": "string", "validation": {"pattern": "^[0-9]{5}$", "on_error": "quarantine"}},
    },
    "target_fields": {
        "key": {"source": "id", "type": "string"},
        "name": {"source": "name", "type": "string", "transform": "upper"},
        "age": {"source": "age", "type": "bigint"},
        "both": {"type": "string", "transform": "concat", "params": {"columns": ["id", "name"], "separator": "/"}},
        "day": {"type": "date", "transform": "current_date"},
        "batch": {"type": "string", "transform": "uuid4"},
        "file": {"type": "string", "transform": "input_file_name"},
    },
}


def test_every_on_error_action(spark):
    data = [
        ("C1", "Annabel", "12", "ny", "40", "12345", "f"),
        ("X1", "Bo", "a", "ca", "30", "12345", "f"),
        ("C2", None, "a", "cal", "x", "1", "f"),
        ("C3", "Cy", None, None, None, None, "f"),
    ]
    df = spark.createDataFrame(data, "id string, name string, phone string, state string, age string, zip string, source_file string")
    fields = m.FieldMapping.from_spec(SPEC)
    accepted, kept_out = m.split_validated(materialize(fields.validate(df)))
    good = {r["id"]: r for r in accepted.collect()}
    assert set(good) == {"C1", "C3"}
    assert good["C1"]["name"] == "Ann" and good["C1"]["state"] == "NY" and good["C1"]["age"] == 40
    bad = {r["id"]: (r["action"], r["reasons"], r["phone"]) for r in kept_out.collect()}
    assert bad == {
        "X1": ("reject", ["id:pattern"], None),
        "C2": ("quarantine", ["age:type", "name:required", "state:length", "zip:pattern"], None),
    }
    out = fields.project(accepted, m.MappingContext("b-1", F.lit("2024-05-06").cast("timestamp"))).orderBy("key").first()
    assert (out["name"], out["both"], str(out["day"]), out["batch"], out["file"]) == ("ANN", "C1/Ann", "2024-05-06", "b-1", "f")


def test_spec_errors(spark):
    with pytest.raises(SpecError):
        m.FieldCheck("a", on_error="explode")
    with pytest.raises(SpecError):
        m.FieldCheck("a", on_error="truncate")
    with pytest.raises(SpecError):
        m.FieldMapping.from_spec({"target_fields": {"x": {"type": "string"}}}).project(spark.range(1))


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `c.d` int")
    assert m.clean_column_names(df).columns == ["a_b", "c_d"]
    with pytest.raises(SpecError):
        m.clean_column_names(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))


def test_schema_differences(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    same = T.StructType.fromDDL("b string, a int")
    assert m.schema_differences(df, same) == []
    other = m.schema_differences(df, T.StructType.fromDDL("a bigint, c string"))
    assert [(d["column_name"], d["difference"]) for d in other] == [("a", "type"), ("b", "unexpected"), ("c", "missing")]
    assert m.missing_columns(df, ["a", "z"]) == ["z"]


def test_protection(spark):
    df = spark.createDataFrame([("s", 5)], "a string, b int")
    key = F.lit("0123456789abcdef")
    with pytest.raises(SpecError):
        protect.protect_columns(df, {"a": "aes", "zz": "aes"}, key)
    sealed = protect.protect_columns(df, {"a": "aes", "b": "sha256"}, key)
    row = materialize(sealed).select("*", protect.decrypt(F.col("a"), key).alias("back")).first()
    assert row["back"] == "s" and row["a"] != "s" and len(row["b"]) == 64
    with pytest.raises(SpecError):
        protect.protect_columns(df, {"a": "aes"})
