"""Scalars on hand-made edge rows."""

from datetime import datetime, timedelta
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from siftline.functions import freshness as D
from siftline.functions import rules as R
from siftline.functions import scores as S
from siftline.functions import text as X
from tests.conftest import AS_OF

x = None


@pytest.fixture(autouse=True)
def _column(spark):
    """Columns need a running session."""
    global x
    x = F.col("x")


def test_normalize_text(values):
    given = [
        "Coupang", "Consultant (Seoul)", "(주) 네이버", "ACME Inc.", "A【b) c", "a　 b\u001cc",
        "[x\ny] z", "  ", "株式会社 Foo  Ltd.", "(a\rb)c",
    ]
    assert values(X.normalize_text(x), given) == [
        "upang", "nsultant", "네이버", "acme", "a c", "a b c", "[x y] z", "", "foo", "c",
    ]


def test_normalize_company_keeps_brackets_and_commas(values):
    given = ["Foo co, (Seoul)", "S.A. Bar", "Baz GmbH"]
    assert values(X.normalize_company(x), given) == ["foo , (seoul)", "s.a. bar", "baz"]


def test_canonical_key_needs_both_halves(frame):
    df = frame([("Foo Inc.", "Dev (x)"), ("Inc.", "Dev"), ("Foo", "(x)")], "c string, t string")
    got = {tuple(r) for r in df.select("c", X.canonical_key(F.col("c"), F.col("t"))).collect()}
    assert got == {("Foo Inc.", "foo|dev"), ("Inc.", ""), ("Foo", "")}


def test_percent_encode_equals_rfc3986(values):
    given = ["a b/c", "삼성 전자", "x*y~z+1&2=3%", "-_.!'()", ""]
    assert values(X.percent_encode(x), given) == [quote(v) for v in given]


def test_people_search_url(values):
    assert values(X.people_search_url(x, F.lit("")), ["A B"])[0].endswith("keywords=A%20B&origin=GLOBAL_SEARCH_HEADER")
    assert "A%20B%20team" in values(X.people_search_url(x, F.lit("team")), ["A B"])[0]


def test_csv_cell_and_cut(values):
    assert values(X.csv_cell(x), ["a\nb\r\nc", None, ""]) == ["a | b | c", "", ""]
    assert values(X.cut(x, 3), ["가나다라", "😀bcd", "ab"]) == ["가나다", "😀bc", "ab"]


def test_experience_bands(values):
    given = ["10년", "11년 이상", "5년 이상", "경력", "경력 3년", "6년", "무관", "신입", "2~5년", "0-2"]
    low, mid, high, other = R.EXPERIENCE_BANDS
    assert values(R.experience_band(x), given) == [
        low, low, mid, high, mid, high, other, low, mid, low,
    ]


def test_role_family_order_and_trailing_blanks(values):
    given = ["SE Manager", "base", "Sales Engineer / Solution", "UX data", "BD", "bd lead", "xyz"]
    want = ["技術營業/Pre-sales", "其他", "技術營業/Pre-sales", "UX Research", "其他", "BD/事業開發", "其他"]
    assert values(R.role_family(x), given) == want


def test_employer_class_order(values):
    given = ["global startup samsung", "startup of lg", "the task", "none here"]
    assert values(R.employer_class(F.lower(x)), given) == [
        R.FOREIGN, R.STARTUP, R.CONGLOMERATE, R.GENERAL,
    ]
    index = R.first_rule_index(F.lower(x), R.EMPLOYER_RULES)
    assert values(R.rule_label(index, R.EMPLOYER_RULES, R.GENERAL), given) == values(
        R.employer_class(F.lower(x)), given
    )


@pytest.mark.parametrize("padding", [0, 300])
def test_keyword_score_floor_and_large_profiles(values, padding):
    unused = tuple(f"never-{i}-found" for i in range(padding))
    profile = R.Profile(("sql", "sql", "NLP") + unused, ("b2b",), ("senior",))
    given = ["SQL and nlp", "senior b2b", "B2B", ""]
    assert values(R.keyword_score(F.lower(x), profile), given) == [9.0, 0.0, 2.0, 0.0]


def test_text_language(values):
    given = ["", None, "한글한 abcdefg", "한글한글abcdef", "abc", "ㄱㄴㄷ"]
    assert values(R.text_language(x), given) == [
        "unknown", "unknown", "English", "Korean", "English", "English",
    ]


def test_parse_iso(values):
    given = [
        "2024-01-05", "20240105", "2024-01-05T10:11", "2024-01-05 10:11:12,5", "2024-01-05T09",
        "2024", "2024-01", "10:00", "~06.30", "2024-02-30", "2024-01-05T10:00+09:00",
        "2024-01-05T10:00:00Z", "", None,
    ]
    day = datetime(2024, 1, 5)
    assert values(D.parse_iso(x), given) == [
        day, day, day + timedelta(hours=10, minutes=11),
        day + timedelta(hours=10, minutes=11, seconds=12, milliseconds=500),
        day + timedelta(hours=9),
    ] + [None] * 9


def test_freshness_days_round_down(values):
    given = ["2024-01-31T12:00:00", "2024-01-30T12:00:00", "2024-01-31", "2024-01-01", "?"]
    assert values(D.freshness_days(x, AS_OF), given) == [-1, 0, 0, 30, None]


def test_labels_and_bonus(values):
    days = [None, -1, 3, 4, 7, 14, 30, 31]
    labels = values(D.freshness_label(x), days, "int")
    assert [v.split(" ")[-1] for v in labels] == [
        "unknown", "0-3d", "0-3d", "4-7d", "4-7d", "8-14d", "15-30d", ">30d",
    ]
    assert values(D.freshness_bonus(x), days, "int") == [0, 10, 10, 8, 8, 5, 2, 0]
    assert values(D.within_age(x), days, "int") == [True] * 7 + [False]


def test_effective_date_tests_blankness_not_readability(frame):
    df = frame([("~06.30",), ("",), (None,)], "p string").withColumn("s", F.lit(AS_OF).cast("timestamp"))
    date = D.effective_date(F.col("p"), F.col("s"))
    days = D.effective_freshness_days(F.col("p"), F.col("s"), "2024-02-02 00:00:00")
    got = {r[0]: (r[1], r[2]) for r in df.select("p", date, days).collect()}
    assert got == {"~06.30": ("~06.30", 2), "": ("2024-01-31T00:00:00", 2), None: ("2024-01-31T00:00:00", 2)}


def test_epoch_to_iso(values):
    given = ["1704067200", "2024-01-01", "", "99999999999999999999", "12a"]
    assert values(D.epoch_to_iso(x), given) == ["2024-01-01T00:00:00", *given[1:]]


def test_clamp(values):
    assert values(S.clamp_score(x), [-1.0, 50.0, 101.0, None], "double") == [0, 50, 100, None]


def test_score_field(values):
    given = [
        '{"score": 70}', '{"score": "70"}', '{"score": 1e2}', "{}", '{"score": null}', '{"score": "x"}',
        "[1]", "no", '```json\n{"score": 5}\n```', "```", '{"score": 7', '  {"score": 3}\n',
    ]
    got = values(S.score_field(S.json_object(S.strip_fence(x))), given)
    assert got == [70, 70, 100, 0, None, None, None, None, 5, None, None, 3]


def test_close_json_and_loose_field(values):
    given = ['{"a": "b', '{"a": {"b": 1', '{"a": 1}', '{"a": "b"', "plain  "]
    assert values(S.close_json(x), given) == [
        '{"a": "b"}', '{"a": {"b": 1}}', '{"a": 1}', '{"a": "b"}', "plain",
    ]
    loose = ['x "k" : "a\\"b\\nc" y', '"k": "open', '"j": "v"', '"k": ""']
    assert values(S.loose_field(x, "k"), loose) == ['a"b\nc', None, None, ""]
    long = '"k": "' + "ab\\n" * 50_000 + '"'
    assert len(values(S.loose_field(x, "k"), [long])[0]) == 150_000


def test_employer_bonus(frame):
    df = frame([(R.FOREIGN, "verified"), (R.FOREIGN, "unverified"), (R.GENERAL, "verified")], "t string, c string")
    got = {tuple(r) for r in df.select("t", "c", S.employer_bonus(F.col("t"), F.col("c"))).collect()}
    assert got == {(R.FOREIGN, "verified", 6.0), (R.FOREIGN, "unverified", 0.0), (R.GENERAL, "verified", 0.0)}


def test_evidence(frame):
    df = frame(
        [(R.FOREIGN, "A Multinational"), (R.FOREIGN, "x" * 9000 + "multinational"), (R.STARTUP, ""),
         (R.STARTUP, "Venture"), (R.GENERAL, "global company")],
        "t string, s string",
    )
    rows = df.select("t", "s", R.evidence_confirms(F.col("t"), F.lower("s")).alias("ok")).collect()
    assert {(r.t, len(r.s), r.ok) for r in rows} == {
        (R.FOREIGN, 15, True), (R.FOREIGN, 9013, True), (R.STARTUP, 0, False), (R.STARTUP, 7, True),
        (R.GENERAL, 14, False),
    }


def test_trend_helpers(frame):
    df = frame([(1.0, 0.0), (1.0, 2.0), (3.0, 3.0)], "n double, b double")
    n, b = F.col("n"), F.col("b")
    got = {tuple(r) for r in df.select("n", "b", S.change_pct(n, b), S.direction(n, b), S.ratio(n, b, 3)).collect()}
    assert got == {(1.0, 0.0, None, "up", 0.0), (1.0, 2.0, -50.0, "down", 0.5), (3.0, 3.0, 0.0, "flat", 1.0)}


def test_dates_with_an_offset_count_where_asked_for(values):
    given = ["2024-01-01T09:00:00+09:00", "2024-01-01 00:00:00,5Z", "2024-01-01", "x", "2024-01-01T09:00"]
    assert values(F.unix_micros(D.parse_instant(F.col("x"))), given) == [
        1704067200_000000, 1704067200_500000, 1704067200_000000, None, 1704099600_000000,
    ]
    assert values(D.parse_iso(F.col("x")).isNull(), given) == [True, True, False, True, False]
