"""CSV dialect cases, files with quoted line ends, round trips."""

import random

import pytest
from pyspark.sql import functions as F

from flowtables.functions import csv
from flowtables.functions.csv import Dialect
from flowtables.operators.csv_records import csv_format, csv_parse, csv_to_map
from flowtables.plans.sizes import scratch_path
from flowtables.sinks.csv_files import csv_write
from flowtables.sources.csv_files import csv_scan

#: Records of a harbour: plain fields, gaps, quotes, escapes, white space, lines in quotes, near misses.
GOOD = [
    ("Ada,12.5,berth 7", ["Ada", "12.5", "berth 7"]),
    ("Ada,12.5\n", ["Ada", "12.5"]),
    ("Ada,12.5\r\n", ["Ada", "12.5"]),
    ("harbour", ["harbour"]),
    (",,tide", ["", "", "tide"]),
    ("tide,", ["tide", ""]),
    ("low,,,high", ["low", "", "", "high"]),
    (",", ["", ""]),
    ("", [""]),
    ("\r\n", [""]),
    ("Łódź,河口,жук,🚢", ["Łódź", "河口", "жук", "🚢"]),
    ('"",open', ["", "open"]),
    ('"""",open', ['"', "open"]),
    ('"so ""late"" again",""', ['so "late" again', ""]),
    ('"9""x11""",map', ['9"x11"', "map"]),
    ('"sand, gravel",8', ["sand, gravel", "8"]),
    ("pier\\,3,west", ["pier,3", "west"]),
    ("up\\\\down,west", ["up\\down", "west"]),
    ('"up\\\\down",west', ["up\\down", "west"]),
    ('"stern\\"bow",west', ['stern"bow', "west"]),
    ('7,"\\"",8', ["7", '"', "8"]),
    (" 4 t ,5 t", [" 4 t ", "5 t"]),
    ('" 4 t ","\t"', [" 4 t ", "\t"]),
    ('"first line\nsecond",z', ["first line\nsecond", "z"]),
    ('"first line\r\n\r\nthird",z', ["first line\r\n\r\nthird", "z"]),
    ('5"8,ft', ['5"8', "ft"]),
    ("\\n,ft", ["\\n", "ft"]),
    ("\\\\,ft", ["\\,ft"]),
    ('\\"q,ft', ['\\"q', "ft"]),
]

BAD = [
    ('keel,\\"', "wrong_escape", 5),
    ("keel,\\", "no_character_after_escape", 5),
    ("keel\\", "no_character_after_escape", 4),
    ('1,"\\', "no_character_after_escape", 3),
    ("1,rope\\s", "wrong_escape", 6),
    ('1,"\\s"', "wrong_escape", 3),
    ('1,"rope"s,2', "delimiter_expected", 8),
    ('"rope', "unterminated_quote", 5),
    ('1,"', "unterminated_quote", 3),
    ('"', "unterminated_quote", 1),
]


def parse(spark, records, dialect=csv.DEFAULT):
    df = spark.createDataFrame(list(enumerate(records)), "i int, rec string")
    return csv_parse(df, "rec", dialect).orderBy("i").collect()


def test_good_records(spark):
    got = parse(spark, [r for r, _ in GOOD])
    assert [(r["rec"], r["fields"], r["error"]) for r in got] == [(r, f, None) for r, f in GOOD]


def test_bad_records(spark):
    got = parse(spark, [r for r, *_ in BAD])
    assert [(r["rec"], r["error"]["reason"], r["error"]["position"]) for r in got] == BAD
    assert all(r["fields"] is None for r in got)


def test_other_dialects(spark):
    got = parse(spark, ["$Foo $#$Bar $#$Baz $"], Dialect("#", "$", "\\"))
    assert got[0]["fields"] == ["Foo ", "Bar ", "Baz "]
    got = parse(spark, ["a;b^;c;'d;''e'"], Dialect(";", "'", "^"))
    assert got[0]["fields"] == ["a", "b;c", "d;'e"]
    got = parse(spark, ["a]b]-c]"], Dialect("]", "[", "-"))
    assert got[0]["error"]["reason"] == "wrong_escape"
    with pytest.raises(ValueError):
        Dialect(",", ",")


def test_error_policies(spark):
    df = spark.createDataFrame([("a,b",), ("a,\\",)], "rec string")
    assert [r["fields"] for r in csv_parse(df, "rec", on_error="skip").collect()] == [["a", "b"]]
    good, bad = csv_parse(df, "rec", on_error="dead_letter")
    assert (good.count(), bad.count()) == (1, 1)
    with pytest.raises(Exception, match="no_character_after_escape"):
        csv_parse(df, "rec", on_error="stop").collect()


def test_long_fields_cost_no_stack(spark):
    text = 'x"\\,' * 200_000
    df = spark.createDataFrame([(text,)], "t string")
    back = csv_parse(csv_format(df, ["t", "t"]), "line", on_error="stop").first()
    assert back["fields"] == [text, text]


def test_format(spark):
    def line(fields, dialect=csv.DEFAULT, always=False):
        df = spark.createDataFrame([(fields,)], "f array<string>")
        return df.select(csv.format_array(F.col("f"), dialect, always)).first()[0]

    assert line(["ett", "två", "tre"]) == "ett,två,tre"
    assert line(["ett", "t,vå", "tre"]) == 'ett,"t,vå",tre'
    assert line(["ett", 't"vå', "tre"]) == 'ett,"t""vå",tre'
    assert line(["ett", "t,vå", "tre"], always=True) == '"ett","t,vå","tre"'
    semicolon = Dialect(delimiter=";")
    assert line(["ett", "t;vå", "tre"], semicolon) == 'ett;"t;vå";tre'
    assert line(["ett", '"', "tre"], semicolon) == 'ett;"""";tre'
    assert line(["ett", "\n", "tre"], semicolon) == 'ett;"\n";tre'
    assert line(["ett", "prefix\\postfix", "tre"], semicolon) == 'ett;"prefix\\\\postfix";tre'
    assert line(["a", None, "c"]) == "a,,c"
    assert line([]) == ""


def test_round_trip_of_random_fields(spark):
    rng = random.Random(5)
    rows = [(i, *("".join(rng.choices('ab,"\\\r\n é', k=rng.randint(0, 9))) for _ in range(3))) for i in range(2000)]
    df = spark.createDataFrame(rows, "i int, a string, b string, c string")
    for always in (False, True):
        back = csv_parse(csv_format(df, ["a", "b", "c"], always=always), "line", on_error="stop")
        assert all(r["fields"] == [r["a"], r["b"], r["c"]] for r in back.collect())


def test_to_map(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["1", "2"]), (3, ["x", "y", "z", "w"])], "at int, fields array<string>")
    got = csv_to_map(df, order="at").orderBy("at").collect()
    assert [r["record"] for r in got] == [{"a": "1", "b": "2"}, {"a": "x", "b": "y", "c": "z"}]
    got = csv_to_map(df, header=["p", "q"]).orderBy("at").collect()
    assert got[0]["record"] == {"p": "a", "q": "b"}


#: Sailings with a remark of several lines, quotes, gaps, and no line end at the end.
SAILINGS = (
    "ship,line,remark,fee\n"
    'Ada,north,"fog, wait for ""clear""",12.50\n'
    'Bo,,"two lines:\nrope, tar",3.00\n'
    ',south,,0\n'
    '"Cleo ""II""",,"",7.25'
)


def write_file(spark, name, data: bytes):
    path = scratch_path(spark, name) + ".csv"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop)
    stream.write(bytearray(data))
    stream.close()
    return path


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("bom", [b"", b"\xef\xbb\xbf"])
def test_scan_of_a_file(spark, end, bom):
    path = write_file(spark, "sailings", bom + SAILINGS.replace("\n", end).encode())
    fields = [tuple(r["fields"]) for r in csv_scan(spark, path, on_error="stop").collect()]
    assert sorted(fields) == sorted([
        ("ship", "line", "remark", "fee"), ("Ada", "north", 'fog, wait for "clear"', "12.50"),
        ("Bo", "", f"two lines:{end}rope, tar", "3.00"), ("", "south", "", "0"), ('Cleo "II"', "", "", "7.25"),
    ])


def test_scan_rejects_other_byte_order_marks(spark):
    for mark in (b"\xff\xfe", b"\xfe\xff"):
        path = write_file(spark, "utf16", mark + b"a\x00,\x00b\x00")
        with pytest.raises(Exception, match="byte order mark"):
            csv_scan(spark, path).collect()


def test_scan_without_quoted_line_ends(spark):
    path = write_file(spark, "plain", b"a,b\r\nc,d\re,f\n")
    got = csv_scan(spark, path, multiline=False, on_error="stop").collect()
    assert sorted(r["fields"] for r in got) == [["a", "b"], ["c", "d"], ["e", "f"]]


def test_scan_of_many_splits(spark):
    """Records with quotes and line ends everywhere, in a file of many splits."""
    rng = random.Random(9)
    rows = [[str(i), *("".join(rng.choices('ab,"\n\\', k=rng.randint(0, 40))) for _ in range(3))] for i in range(3000)]

    def field(f):
        special = any(c in f for c in ',"\n\\')
        return '"' + f.replace("\\", "\\\\").replace('"', '""') + '"' if special else f

    text = "".join(",".join(map(field, r)) + "\n" for r in rows)
    path = write_file(spark, "splits", text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scanned = csv_scan(spark, path, on_error="stop")
        got = scanned.select("line", "fields").collect()
        assert spark.read.text(path).rdd.getNumPartitions() > 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got.sort(key=lambda r: r["line"])
    assert [r["fields"] for r in got] == rows


def test_broken_quote_does_not_swallow_good_lines(spark):
    path = write_file(spark, "broken", b'a,"b"x\nc,d\n"e\\q",f\n"g\nh",i\n')
    got = {r["line"]: r for r in csv_scan(spark, path).collect()}
    assert got[1]["error"]["reason"] == "delimiter_expected"
    assert got[2]["fields"] == ["c", "d"]
    assert got[3]["error"]["reason"] == "wrong_escape"
    assert got[4]["fields"] == ["g\nh", "i"]


def test_lines_after_an_unclosed_quote_are_errors(spark):
    path = write_file(spark, "endless", b'a,b\n"open\n' + b"x\n" * 50)
    got = sorted(csv_scan(spark, path).collect(), key=lambda r: r["line"])
    assert [r["line"] for r in got] == list(range(1, 53)) and got[0]["fields"] == ["a", "b"]
    assert [r["record"] for r in got[1:]] == ['"open'] + ["x"] * 50
    assert {(r["error"]["reason"], r["fields"]) for r in got[1:]} == {("unterminated_quote", None)}


def test_long_record_is_whole(spark):
    path = write_file(spark, "long", b'a,b\n"' + b"x\n" * 100_050 + b'",y\nc,d\n')
    got = {r["line"]: r["fields"] for r in csv_scan(spark, path, on_error="stop").collect()}
    assert got == {1: ["a", "b"], 2: ["x\n" * 100_050, "y"], 100_053: ["c", "d"]}


def test_write_and_scan(spark):
    df = spark.createDataFrame([(i, f'v"{i}\n,', None) for i in range(100)], "i int, v string, n string").repartition(3)
    path = scratch_path(spark, "written")
    csv_write(df, path, ["i", "v", "n"], line_end="\n", bom=True, header=True)
    raw = spark.read.format("binaryFile").load(path).collect()
    assert len(raw) == 3 and all(bytes(r["content"]).startswith(b"\xef\xbb\xbfi,v,n\n") for r in raw)
    got = csv_scan(spark, path, on_error="stop").where("line > 1")
    assert sorted(r["fields"] for r in got.collect()) == sorted([str(i), f'v"{i}\n,', ""] for i in range(100))
