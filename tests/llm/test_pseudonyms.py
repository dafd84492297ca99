import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.pseudonyms import PseudonymOptions, feistel, with_pseudonyms
from tests.llm.conftest import EDGES

TEXTS = {
    "card 4111 1111 1111 1111 and 4111111111111111, no 4111111111111112": ["card", "card"],
    "iban DE89370400440532013000 no DE88370400440532013000": ["iban"],
    "on 2024-02-29 or 29.02.2024 or 02/29/2024 not 2023-02-29": ["date"] * 3,
    "ip 192.168.1.10 no 999.1.1.1 no 1.2.3.04": ["ip"],
    "ssn 123-45-6789 no 000-12-3456 no 666-12-3456": ["ssn"],
    "call +1 (017) 555-7713 or (212) 555-0100": ["phone", "phone"],
    "mail wer.34@mail7.example.com.": ["email"],
    "4111111111111111!!": ["card"],
    "no numbers": [],
    "iban DE89 3704 0044 0532 0130 00 and CH93 0076 2011 6238 5295 7 no DE89 3704 0044 0532 0130 01": ["iban", "iban"],
    "call +44 20 7946 0958, +33 1 42 68 53 00 or +49.30.901820 no +1 23 no +12 3456 7890 1234 5678 9": ["phone"] * 3,
    "see http://10.0.0.1/ and 2024/02/29 no 31/12/2020 no a/4111111111111111": ["ip", "date"],
    "x4111111111111111 id-4111111111111111 1.411111111111111": [],
}


def luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return sum(v if k % 2 == 0 else sum(divmod(2 * v, 10)) for k, v in enumerate(values)) % 10 == 0


@pytest.fixture(scope="module")
def made(spark, docs):
    rows = [(k, text) for k, text in enumerate(TEXTS)]
    return {r.doc_id: r for r in with_pseudonyms(docs(rows)).collect()}


def test_kinds_and_formats(made):
    for k, (text, kinds) in enumerate(TEXTS.items()):
        new = made[k].text
        assert made[k]._found == kinds
        assert (new != text) == bool(kinds)
        if "ip" not in kinds and kinds:
            assert re.sub("[0-9]", "9", re.sub("[a-z]", "a", new)) == re.sub("[0-9]", "9", re.sub("[a-z]", "a", text))


def test_equal_values_are_linked_over_formats(made):
    cards = re.findall(r"\d{4} ?\d{4} ?\d{4} ?\d{4}", made[0].text)
    assert cards[0].replace(" ", "") == cards[1] and luhn(cards[1]) and made[7].text == cards[1] + "!!"
    days = re.search(r"on (\S+) or (\S+) or (\S+)", made[2].text).groups()
    assert len({datetime.strptime(d, f).date() for d, f in zip(days, ("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y"))}) == 1


def test_iban_stays_valid(made):
    iban = re.search(r"DE\d{20}", made[1].text).group()
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def test_grouped_iban_is_linked_to_the_whole_one(made):
    whole = re.search(r"DE\d{20}", made[1].text).group()
    assert re.search(r"DE[\d ]+\d", made[9].text).group().replace(" ", "") == whole
    iban = re.search(r"CH\d\d(?: \d{4}){4} \d", made[9].text).group().replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def test_undo_is_exact(spark, docs):
    rows = [*enumerate(TEXTS, 100), *EDGES]
    hidden = with_pseudonyms(docs(rows)).drop("_found")
    back = with_pseudonyms(hidden, undo=True).select("doc_id", "text").collect()
    assert sorted(map(tuple, back), key=repr) == sorted(rows, key=repr)


def test_keys_differ(docs):
    text = "4111111111111111"
    one, two = (with_pseudonyms(docs([(1, text)]), options=PseudonymOptions(key=k)).first().text for k in "ab")
    assert one != two


@pytest.mark.parametrize("radices", [[10], [2, 3], [3, 5, 4], [7, 1, 2]])
def test_feistel_is_a_permutation(spark, radices):
    domain = [[]]
    for radix in radices:
        domain = [d + [v] for d in domain for v in range(radix)]
    df = spark.createDataFrame([(d, radices) for d in domain], "v array<int>, r array<int>")
    options = PseudonymOptions()
    moved = df.select("v", "r", feistel(F.col("v"), F.col("r"), "t", options).alias("m"))
    rows = moved.select("v", "m", feistel(F.col("m"), F.col("r"), "t", options, undo=True).alias("back")).collect()
    assert sorted(r.m for r in rows) == sorted(domain) and all(r.back == r.v for r in rows)


def test_all_days_stay_in_range(spark, docs):
    days = [(k, date.fromordinal(date(1900, 1, 1).toordinal() + k * 997).isoformat()) for k in range(73)]
    new = [r.text for r in with_pseudonyms(docs(days)).collect()]
    assert len(set(new)) == 73 and all("1900-01-01" <= d <= "2099-12-31" for d in new)


def test_plan_is_native(docs):
    plan = with_pseudonyms(docs(EDGES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
