import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tideline.operators import words

LINES = ["this is an example", "this is the first example"]


def lines(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "line_id long, value string")


def test_word_count(spark):
    counts = words.word_count(words.tokenize(lines(spark, LINES)))
    expected = {"this": 2, "is": 2, "example": 2, "an": 1, "the": 1, "first": 1}
    assert dict(rows_of(counts)) == expected


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("a b  c  ", ["a", "b", "", "c"]),
        ("", [""]),
        ("   ", []),
        (" a", ["", "a"]),
        ("This", ["this"]),
    ],
)
def test_split_rules(spark, line, expected):
    tokens = words.tokens_at(lines(spark, [line]), "value", "line_id").orderBy("pos")
    assert [row.word for row in tokens.collect()] == expected
    tagged = words.parametrized_tokenize(lines(spark, [line]), "line_id", "value", {"tag": "x"})
    assert [(r.word, r.one, r.tag) for r in tagged.collect()] == [(w, 1, "x") for w in expected]


def test_null_texts_have_no_words(spark):
    source = spark.createDataFrame([(1, None), (2, "a  B "), (3, ""), (4, " ")], "line_id long, value string")
    tokens = words.tokenize(source, keep=["line_id"]).select("line_id", "word")
    tagged = words.parametrized_tokenize(source, "line_id", "value", {"tag": "x"})
    assert rows_of(tagged, "line_id", "word") == rows_of(tokens)


def test_options(spark):
    kept = words.tokenize(lines(spark, ["This  is"]), lower=False, drop_empty=True)
    assert rows_of(kept, "word") == [("This",), ("is",)]


def test_running_count_of_a_frequent_word(spark, small_chunks):
    source = lines(spark, ["a b a", "b a", "a", "", "a a b", "b", "a"])
    tokens = words.tokens_at(source, "value", "line_id")
    found = rows_of(words.word_count_running(tokens, "line_id", hot_rows=2), "line_id", "pos", "word", "n")
    seen, expected = {}, []
    for row in tokens.orderBy("line_id", "pos").collect():
        seen[row.word] = seen.get(row.word, 0) + 1
        expected.append((row.line_id, row.pos, row.word, seen[row.word]))
    assert found == sorted(expected, key=repr)


def test_setup_and_teardown_run_once_per_task(spark, tmp_path):
    log = str(tmp_path / "log")

    def note(text):
        with open(log, "a") as file:
            file.write(text + "\n")

    def setup(parameters):
        note("open " + parameters["p"])
        return lambda batch: batch

    source = spark.range(1000, numPartitions=1)
    done = words.flat_map_with_setup(source, setup, {"p": "v"}, "id long", lambda: note("close"))
    assert done.agg(F.sum("id")).first()[0] == 499500
    assert open(log).read().split("\n")[:2] == ["open v", "close"]


def test_table_function_life_cycle(spark, tmp_path):
    """Set up once per partition, torn down once, in a call from DataFrames and from SQL."""
    import uuid

    import pyarrow as pa

    folder = str(tmp_path)

    def note(what):
        open(f"{folder}/{what}-{uuid.uuid4().hex}", "w").close()

    def setup(parameters):
        note("open")

        def twice(batch):
            n = pa.concat_arrays([batch.column("n"), batch.column("n")])
            return pa.table([n, pa.repeat(parameters["tag"], len(n))], names=["n", "tag"])

        return twice

    double = words.table_function(setup, {"tag": "x"}, "n long, tag string", lambda: note("close"))
    numbers = spark.range(0, 1000, 1, 5).withColumnRenamed("id", "n")
    want = sorted([(n, "x") for n in range(1000)] * 2, key=repr)
    assert rows_of(double(numbers.asTable())) == want
    assert len(list(tmp_path.glob("open-*"))) == len(list(tmp_path.glob("close-*"))) == 5
    spark.udtf.register("double_rows", double)
    numbers.createOrReplaceTempView("numbers_to_double")
    found = spark.sql("SELECT n, tag FROM double_rows(TABLE(SELECT * FROM numbers_to_double))")
    assert rows_of(found) == want
    plan = double(numbers.asTable())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_tokenizer_is_the_tokenizer(spark):
    lines = [(1, "A b  c "), (2, ""), (3, "   "), (4, None), (None, "x"), (6, "É\tü z")]
    df = spark.createDataFrame(lines, "doc_id long, text string").repartition(3)
    by_function = words.tokenizer("doc_id", "text", "bigint", {"tag": "t"})(df.asTable())
    by_frame = words.parametrized_tokenize(df, "doc_id", "text", {"tag": "t"})
    assert rows_of(by_function) == rows_of(by_frame)
    assert by_function.schema == by_frame.schema
    assert words.tokenizer("doc_id", "text", "bigint", {"tag": "t"})(df.limit(0).asTable()).count() == 0
