"""Edge-line table (FIXTURES.md §4) and parser properties."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelrec import schemas
from reelrec.functions import parse, wire


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("line,expected,reason", [
    ("1,114709,862", (1, 114709, 862), None),
    ("1,0114709,862", (1, 114709, 862), None),
    ("1,114709,", None, None),                      # dropped: ends with the delimiter (P1)
    ("movieId,imdbId,tmdbId", None, "bad int: movieId"),
    ("1,114709", None, "too few fields"),
    ("1,114709,862,extra", (1, 114709, 862), None),  # extra fields ignored
])
def test_links_edges(spark, line, expected, reason):
    res = parse.parse_delimited(lines(spark, line), schemas.LINKS, ",")
    assert rows(res.rows) == ([expected] if expected else [])
    got = rows(res.rejects)
    assert got == ([(line, reason)] if reason else [])


def test_movies_naive_split_cuts_quoted_title(spark):
    line = '11,"American President, The (1995)",Comedy'
    res = parse.parse_delimited(lines(spark, line), schemas.MOVIES, ",")
    assert rows(res.rows) == [(11, '"American President', 'The (1995)"')]
    quoted = parse.parse_csv_quoted(lines(spark, line), schemas.MOVIES)
    assert rows(quoted.rows) == [(11, "American President, The (1995)", "Comedy")]


def test_generation2_lines(spark):
    res = parse.parse_delimited(lines(spark, "1::Toy Story (1995)::Animation|Comedy", "1::Toy Story (1995)::"),
                                schemas.MOVIES, "::")
    assert rows(res.rows) == [(1, "Toy Story (1995)", "Animation|Comedy")]
    users = parse.parse_delimited(lines(spark, "1::F::1::10::48067"), schemas.USERS, "::")
    assert rows(users.rows) == [(1, "F", 1)]


def test_ratings_trim_and_bad_double(spark):
    res = parse.parse_delimited(lines(spark, "1,31,2.5,1260759144", " 1 ,\t31,2.5,1260759144", "1,31,x,1260759144"),
                                schemas.RATINGS, ",")
    assert sorted(rows(res.rows)) == [(1, 31, 2.5, 1260759144)] * 2
    assert rows(res.rejects) == [("1,31,x,1260759144", "bad double: rating")]


def test_fail_and_drop_modes(spark):
    df = lines(spark, "1,2,3", "x,2,3")
    assert rows(parse.parse_delimited(df, schemas.LINKS, ",", on_error="drop").rows) == [(1, 2, 3)]
    with pytest.raises(Exception, match="unparsable line"):
        parse.parse_delimited(df, schemas.LINKS, ",", on_error="fail").rows.collect()


@pytest.mark.parametrize("line,expected,reason", [
    ('15,339,sandra "boring" bullock,1138537770', (15, 339, "sandra boring bullock", 1138537770), None),
    ('15,1,a,b,"c",5', (15, 1, "abc", 5), None),
    ("1,2,3", (1, 2, "", 3), None),
    ("1,2", None, "too few fields"),
    ("1,2,x,", None, None),
    ("1,2,,,7", (1, 2, "", 7), None),
    ("a,2,x,3", None, "bad int: userId"),
])
def test_tag_repair_edges(spark, line, expected, reason):
    res = parse.parse_tag_lines(lines(spark, line), schemas.TAGS)
    assert rows(res.rows) == ([expected] if expected else [])
    assert rows(res.rejects) == ([(line, reason)] if reason else [])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet='ab ,"', max_size=8), min_size=1, max_size=4))
def test_tag_repair_never_leaves_commas_or_quotes(spark, words):
    line = "7,9," + ",".join(words) + ",123"
    got = rows(parse.parse_tag_lines(lines(spark, line), schemas.TAGS).rows)
    assert len(got) == 1
    assert "," not in got[0][2] and '"' not in got[0][2]


@pytest.mark.parametrize("value,expected,reason", [
    ("7%11%4.5", (7, 11, 4.5), None),               # user is field 0 (D4 ruling)
    ("bad", None, "too few fields"),
    ("", None, "too few fields"),
    (None, None, "too few fields"),
])
def test_wire_decode_edges(spark, value, expected, reason):
    df = spark.createDataFrame([("real-time", value)], "key string, value string")
    res = wire.decode(df)
    assert rows(res.rows) == ([expected] if expected else [])
    assert len(rows(res.rejects)) == (1 if reason else 0)


@pytest.mark.parametrize("value,user", [("7%11%4.5", 7), ("7%11%x", 7), ("8%11", 8), ("9", 9), (" 10 %", 10), ("x%1%2", None), ("", None), (None, None), ("%3", None)])
def test_requests_need_the_user_only(spark, value, user):
    res = wire.decode_users(spark.createDataFrame([("real-time", value)], "key string, value string"))
    assert rows(res.rows) == ([(user,)] if user is not None else [])
    assert len(rows(res.rejects)) == (0 if user is not None else 1)


@pytest.mark.parametrize("line,expected", [
    ('1,"He said ""hi"", ok (1990)",Drama', (1, 'He said "hi", ok (1990)', "Drama")),
    (' 2 ,"a, b",c|d', (2, "a, b", "c|d")), ("3,plain,x", (3, "plain", "x")), ('4,"only, two"', None), ("5,two", None), ('6,"",g', (6, "", "g")),
])
def test_quoted_lines(spark, line, expected):
    res = parse.parse_csv_quoted(lines(spark, line), schemas.MOVIES)
    assert rows(res.rows) == ([expected] if expected else [])
    assert len(rows(res.rejects)) == (0 if expected else 1)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**31 - 1), st.integers(0, 2**31 - 1),
                          st.sampled_from([0.5, 1.0, 2.5, 3.5, 5.0])), min_size=1, max_size=5))
def test_wire_roundtrip(spark, triples):
    df = spark.createDataFrame(triples, schemas.RATING_TRIPLE)
    back = wire.decode(wire.encode(df)).rows
    assert sorted(rows(back)) == sorted(triples)


@pytest.mark.parametrize("text,as_int,as_double", [
    ("1.0", None, 1.0), ("+5", 5, 5.0), ("007", 7, 7.0), ("1e3", None, 1000.0), ("0x10", None, None),
    ("NaN", None, None), ("Infinity", None, None), ("-Infinity", None, None), ("2147483648", None, 2147483648.0), ("2.5d", None, 2.5), ("1_000", None, None),
])
def test_numbers_follow_java_parsing(spark, text, as_int, as_double):
    """toInt / toDouble parity: what Java rejects is quarantined, what it accepts parses, but for
    NaN and infinities, which are no ratings."""
    ints = parse.parse_delimited(lines(spark, f"{text},1,1"), schemas.LINKS, ",", on_error="drop").rows.collect()
    assert [r["movieId"] for r in ints] == ([as_int] if as_int is not None else [])
    dbl = parse.parse_delimited(lines(spark, f"1,2,{text},3"), schemas.RATINGS, ",", on_error="drop").rows.collect()
    got = [r["rating"] for r in dbl]
    if as_double is None:
        assert got == []
    else:
        assert got == [as_double]
