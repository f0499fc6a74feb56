import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from tagweave.functions import text as fn
from tagweave.functions.hashing import hash_tokens, murmur3_bytes, murmur3_long, stable_hash
from tagweave.functions.stemming import porter_stem, stem_tokens
from tagweave.functions.stopwords import ENGLISH
from tagweave.operators import text as tx
from tagweave.options import Options

POSTS = "uniqueID long, title string, body string, domain string"


def posts(spark, *rows):
    return spark.createDataFrame([(i, t, b, "d") for i, (t, b) in enumerate(rows)], POSTS)


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_math_is_stripped_in_order_and_not_across_lines(spark):
    rows = ["a $$q$$ b", "a $x$ b", r"a \begin{align} x \end{align} b", "a $x\ny$ b", "cost $5"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    assert one(df, fn.strip_math(F.col("t"))) == ["a  b", "a  b", "a  b", "a $x\ny$ b", "cost $5"]
    assert one(df, fn.strip_math(F.col("t"), dotall=True))[3] == "a  b"


def test_document_sentences_and_words(spark):
    df = spark.createDataFrame([("  Is it\n dark? Yes, it is.. Really ", )], "t string")
    document = fn.assemble_document(F.col("t"))
    assert one(df, document) == ["Is it dark? Yes, it is.. Really"]
    assert one(df, fn.split_sentences(document)) == [["Is it dark?", "Yes, it is..", "Really"]]
    assert one(df, fn.split_words(document))[0][:3] == ["Is", "it", "dark"]
    assert one(df, fn.split_words(document, True))[0][:4] == ["Is", "it", "dark", "?"]


@pytest.mark.parametrize("lower", [True, False])
def test_fused_normaliser_equals_the_per_token_one(spark, lower):
    rows = ["a1b 22 c3 don't x_y É9é", "", "42", "A-B2C 3d", "naïve Straße 10km ²x"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    slow = fn.normalize_tokens(fn.split_words(F.col("t")), lower)
    assert one(df, fn.split_normalized_words(F.col("t"), lower)) == one(df, slow)


def test_text_options(spark):
    df = posts(spark, ("Why do Sunspots appear dark?", ""), ("How are black holes found?", ""))
    normal = Options(normalize=True, lower_case=True)
    title = one(tx.tokenize(df, normal), "title")
    assert title[0] == ["sunspots", "appear", "dark"]
    assert len(title[1]) < 5
    stemmed = tx.tokenize(df, Options(normalize=True, lower_case=True, stem=True))
    assert one(stemmed, "title")[0] == ["sunspot", "appear", "dark"]


def test_defaults_keep_case_and_numbers(spark):
    df = posts(spark, ("Top 10 Stars of 2019", "The END"))
    row = tx.tokenize(df, Options(lower_case=True)).first()
    assert row["title"] == ["Top", "10", "Stars", "2019"]
    assert row["body"] == ["END"]


def test_stop_list_is_sparks_default(spark):
    assert ENGLISH == StopWordsRemover.loadDefaultStopWords("english")


def test_ngrams_of_short_and_long_rows(spark):
    df = posts(spark, ("red green blue", "one"), ("", "x y"))
    tokens = tx.tokenize(df, Options(ngrams=2))
    assert one(tokens, "titleNGrams") == [["red green", "green blue"], []]
    assert one(tokens, "bodyNGrams") == [[], ["x y"]]
    merged = tx.merge_fields(tx.merge_ngrams(tokens))
    assert one(merged, "titleBody")[0] == ["red", "green", "blue", "red green", "green blue", "one"]


def test_item_counts_match_a_plain_count(spark):
    rows = [(0, ["b", "a", "b"]), (1, []), (2, ["z"]), (3, ["q"] * 500 + ["p"])]
    df = spark.createDataFrame(rows, "id long, items array<string>")
    found = {(r["id"], r["term"]): r["n"] for r in tx.item_counts(df, "items", ["id"]).collect()}
    assert found == {(i, t): items.count(t) for i, items in rows for t in items}


def test_occurrence_maps(spark):
    tokens = spark.createDataFrame([(1, ["a", "b", "a"], []), (2, [], ["c"])], "uniqueID long, title array<string>, body array<string>")
    samples = spark.createDataFrame([(1, "d"), (2, "d"), (3, "d")], "uniqueID long, domain string")
    rows = {r["uniqueID"]: r for r in tx.token_occurrences(samples, tokens, Options()).collect()}
    assert set(rows) == {1, 2}
    assert sorted(rows[1]["titleFeatures"].values()) == [1, 2] and rows[1]["bodyFeatures"] == {}
    assert list(rows[2]["bodyFeatures"].values()) == [1]


# Published example words of the stemming paper.
STEMS = """
caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster
bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan
falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat
conditional condit rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform
radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam predication predic
operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal
sensitiviti sensit sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr
electrical electr hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin
gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust
dependent depend adoption adopt homologou homolog communism commun activate activ angulariti angular
homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control
roll roll
""".split()


def test_stems_of_the_paper(spark):
    pairs = dict(zip(STEMS[::2], STEMS[1::2]))
    assert {w: porter_stem(w) for w in pairs} == pairs
    df = spark.createDataFrame([(list(pairs),), ([],), (None,)], "t array<string>")
    assert one(df, stem_tokens("t")) == [list(pairs.values()), [], None]


def test_murmur_vectors():
    # Published test values of the x64 128-bit variant, low half, seed 0.
    assert murmur3_bytes(b"") == 0
    assert murmur3_bytes(b"foo") == -2129773440516405919
    fox = murmur3_bytes(b"The quick brown fox jumps over the lazy dog")
    assert fox % 2**64 == 0xE34BBC7BBC071B6C
    assert murmur3_long("a") == murmur3_bytes(b"a\x00")


def test_token_hashes_keep_order_and_repeats(spark):
    df = spark.createDataFrame([(["x", "y", "x"],), ([],)], "t array<string>")
    for method in ("xxhash64", "murmur3_128"):
        first, empty = one(df, hash_tokens(F.col("t"), method))
        assert first[0] == first[2] != first[1] and empty == []
    assert one(df, hash_tokens(F.col("t"), "murmur3_128"))[0][1] == murmur3_long("y")


def test_stable_hash_is_the_md5_prefix(spark):
    import hashlib

    df = spark.createDataFrame([(7,)], "k long")
    expected = int(hashlib.md5(b"3:7").hexdigest()[:8], 16)
    assert one(df, stable_hash(F.col("k"), 3)) == [expected]


def test_a_text_without_formulas_is_not_matched(spark, monkeypatch):
    rows = spark.createDataFrame([("no marks",), ("a $x$ b",), (r"c \begin{a}x\end{a} d",), (None,)], "text string")
    assert [r[0] for r in rows.select(fn.strip_math(F.col("text"))).collect()] == ["no marks", "a  b", "c  d", None]
    monkeypatch.setattr(fn, "MATH_PATTERN", "marks")  # is tried only where a formula may begin
    assert [r[0] for r in rows.select(fn.strip_math(F.col("text"))).collect()][0] == "no marks"
