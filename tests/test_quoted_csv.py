"""The parallel reader against Spark's own, on files cut into very many splits."""

import random

import pytest

from tagweave.sources import posts, quoted_csv

DIALECT = {"header": False, "sep": "|", "multiLine": True, "quote": '"', "escape": '"'}
AWKWARD = "\n".join(
    [
        '1|"plain"|"body"|d',
        '2|"two\nlines"|"a ""quoted"" word\n\n\nand | more"|"d\r"',
        "",
        "3|no quotes|5\" pipe and a \"word\"|d",
        '4|""|""|""',
        "5|||",
        "x|not a number|body|d",
        "6|short",
        '7|"ends in quote """|""""|d',
        '8|"' + "long line\n" * 120 + '"|"' + "z" * 900 + '"|d',
        '9|"a"b|c|d',
        '10|"",""|"|"|d',
        '11|tab\there|"é 日本  "|d',
        '"12"|"quoted number"|"\n"|d',
        '13|"""\n"""|"\n\n"|"d"',
    ]
)


def records(seed, n):
    draw = random.Random(seed)
    cell = lambda: "".join(draw.choices(["a", " ", "|", '""', "\n", "word", "é"], k=draw.randrange(0, 30)))
    return "".join(f'{i}|"{cell()}"|"{cell()}"|dom{i % 3}\n' for i in range(n))


def both(spark, folder, size):
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        lines = quoted_csv._lines(spark, f"{folder}/*.csv")
        tasks = lines.rdd.getNumPartitions()
        found = quoted_csv.read_quoted_csv(spark, f"{folder}/*.csv", posts.TEXT_SCHEMA).collect()
    finally:
        spark.conf.set(name, old)
    expected = spark.read.schema(posts.TEXT_SCHEMA).options(**DIALECT).csv(f"{folder}/*.csv").collect()
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    return key(found), key(expected), tasks


@pytest.mark.parametrize("size", ["150", "128m"])
def test_equal_to_sparks_reader(spark, tmp_path, size):
    (tmp_path / "awkward.csv").write_text(AWKWARD + "\n", newline="")
    (tmp_path / "no-end.csv").write_text('1|a|b|c\n2|"x\ny"|z|w', newline="")
    (tmp_path / "many.csv").write_text(records(1, 150), newline="")
    (tmp_path / "blank.csv").write_text("\n\n", newline="")
    (tmp_path / "empty.csv").write_text("")
    found, expected, tasks = both(spark, tmp_path, size)
    assert found == expected and len(found) > 160
    assert tasks > 50 if size == "150" else tasks >= 1


@pytest.mark.parametrize("size", ["400"])
def test_line_ends_of_two_characters(spark, tmp_path, size):
    text = (AWKWARD.replace('"d\r"', "d") + "\n" + records(2, 60)).replace("\n", "\r\n")
    (tmp_path / "dos.csv").write_text(text, newline="")
    found, expected, _ = both(spark, tmp_path, size)
    assert found == expected


def test_one_record_over_very_many_splits(spark, tmp_path):
    text = '1|"' + "a line\n" * 3_000 + '"|"b"|d\n2|x|y|z\n3|"' + "|" * 2_000 + "\n" * 2_000 + '"|"b"|d\n'
    (tmp_path / "long.csv").write_text(text, newline="")
    found, expected, tasks = both(spark, tmp_path, "1000")
    assert found == expected and [r[0] for r in found] == [1, 2, 3] and tasks > 20


def test_a_large_file_is_read_by_many_tasks_without_the_text_moving(spark, tmp_path):
    (tmp_path / "postText1.csv").write_text(records(3, 3_000), newline="")
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    spark.conf.set(name, "16k")
    try:
        lines = quoted_csv._lines(spark, f"{tmp_path}/*.csv")
        assert lines.rdd.getNumPartitions() >= 8
        plan = quoted_csv._records(lines, quoted_csv.split_states(lines, "|"), "|")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        assert posts.read_post_text(spark, str(tmp_path)).count() == 3_000
    finally:
        spark.conf.set(name, old)


@pytest.mark.parametrize(
    ("line", "inside", "after"),
    [
        ("a|b", False, False), ("a|b", True, True), ('a|"b', False, True), ('b"|c', True, False), ('b""|c', True, True),
        ('5" pipe', False, False), ('"a"b"c', False, False), ('""', False, False), ('"', False, True), ('"', True, False),
        ('"""', False, True), ('""""', False, False), ('"a" |"b', False, True), ('|"', False, True), ("", True, True),
    ],
)
def test_what_a_line_does_to_the_state(line, inside, after):
    assert quoted_csv.ends_inside(line, inside, "|") == after
