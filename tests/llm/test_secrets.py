import math
import random
import re
import time

from pyspark.sql import functions as F

from corpusloom.llm.secrets import ALLOWED, CLASSES, PLACEHOLDERS, peak_entropy, with_secrets
from corpusloom.llm.spans import listed
from tests.llm import brute
from tests.llm.conftest import EDGES

PARTS = [
    "password", "Token", "api_key", "APIKEY", "secret", "AKIA", "=", ":", " ", '"', "'", "abcdef",
    "0123456789abcdef01234567", "ABCDEFGH12345678", "x", "é", "\n", "🙂", ".", "-", "ſecret", "toKen",
]


def test_base_spans_match_brute_force(docs):
    rng = random.Random(2)
    rows = EDGES + [(100 + k, "".join(rng.choices(PARTS, k=rng.randint(1, 40)))) for k in range(300)]
    found = with_secrets(docs(rows)).select("doc_id", "text", listed(F.col("_base")).alias("base")).collect()
    assert [r.base for r in found] == [brute.base_secrets(r.text) for r in found]
    assert len(found) == len(rows)


def windows_entropy(text, window):
    best = 0.0
    for k in range(len(text) - window + 1):
        part = text[k : k + window]
        best = max(best, -sum(part.count(c) / window * math.log2(part.count(c) / window) for c in set(part)))
    return best


def test_incremental_entropy_is_the_entropy(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcAB01+/"[: rng.randint(1, 9)], k=rng.randint(1, 80))) for _ in range(100)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", peak_entropy(F.col("t"), 20).alias("e"))
    assert all(abs(r.e - windows_entropy(r.t, 20)) < 1e-9 for r in df.collect())


def test_method_adds_spans_and_allow_list_suppresses(docs):
    cases = {
        "ghp_k3Jf92LsQ0aZxT7bW1mVn5Rc8Y": True,
        "550e8400-e29b-41d4-a716-446655440000": False,
        "/usr/local/share/fonts/truetype": False,
        "20240101202401012024010120240101": False,
        "Donaudampfschifffahrtsgesellschaft": False,
        "EXAMPLEk3Jf92LsQ0aZxT7bW1mVn5Rc8Y": False,
        "0123456789abcdef01234567": False,  # a base span already
    }
    rows = [(k, f"é {text}!") for k, text in enumerate(cases)]
    found = {r.doc_id: [s.kind for s in r._spans] for r in with_secrets(docs(rows)).collect()}
    assert [("entropy" in found[k]) for k in range(len(cases))] == list(cases.values())
    span = next(s for s in with_secrets(docs(rows[:1])).first()._spans)
    assert (span.start, span.end) == (2, 32)


def brute_spans(text, window=20):
    """All spans, with every window's entropy counted from its characters."""
    text = text or ""
    base = [s for s in brute.base_secrets(text).split(",") if s]
    left = list(text)
    # Base matches are blanked out kind by kind.
    for pattern, least, group in ((brute.ASSIGN, 6, 2), (re.compile(r"AKIA[A-Z0-9]+"), 20, 0), (re.compile(r"[0-9a-f]+"), 24, 0)):
        for m in pattern.finditer("".join(left)):
            if len(m.group(group)) >= least:
                left[m.start() : m.end()] = " " * (m.end() - m.start())
    found = [(int(s.split(":")[1]), ("assign", "access", "hex").index(s.split(":")[0]), s) for s in base]
    for m in re.finditer(r"[A-Za-z0-9+/_=-]+", "".join(left)):
        run = m.group()
        if len(run) < window or any(re.search(p.replace(r"\z", r"\Z"), run) for p in ALLOWED):
            continue
        holds = re.search(PLACEHOLDERS, run)
        if len(run) <= 2 * window and holds:
            continue
        least = next(bound for _, shape, bound in CLASSES if re.search(shape.replace(r"\z", r"\Z"), run))
        judged = run if len(run) <= 2 * window else re.sub(PLACEHOLDERS, "", run)
        if windows_entropy(judged, window) >= least:
            found.append((m.start(), 3, f"entropy:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(found))


def test_all_spans_match_brute_force(docs, spark):
    rng = random.Random(5)
    alphabet = "".join(map(chr, range(43, 123)))
    keys = ["".join(c for c in rng.choices(alphabet, k=rng.randint(15, 90)) if re.match(r"[A-Za-z0-9+/_=-]", c)) for _ in range(150)]
    extra = [*keys, "0" * 9, "EXAMPLE", "a" * 8, "/", "=", "word-word-word", "550e8400-e29b-41d4-a716-446655440000"]
    rows = EDGES + [(100 + k, "".join(rng.choices(PARTS + extra, k=rng.randint(1, 12)))) for k in range(300)]
    rows += [(1000 + r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    found = with_secrets(docs(rows)).select("doc_id", "text", listed(F.col("_spans")).alias("spans")).collect()
    assert len(found) == len(rows) and sum("entropy" in r.spans for r in found) > 100
    for r in found:
        assert r.spans == brute_spans(r.text), r.text


def test_suppression_takes_no_more_than_its_part(docs):
    key = "k3Jf92LsQ0aZxT7bW1mVn5Rc8Y"
    private = "b3BlbnNzaC1rZXktdjEAAAAABG5vbmUAAAAEbm9uZQAAAAAAAAABAAABlwAAAAdzc2gtcn"
    cases = [f"{key}/api_key=abcdef", f"token=abcdefg {key}", private, "Zk3Jf92LsQ0aZxT7bExamplW1mVn5Rc8YExamplePq9"]
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r._spans] for r in with_secrets(docs(list(enumerate(cases)))).collect()}
    assert found[0] == [("entropy", 0, 27), ("assign", 27, 41)]
    assert found[1] == [("assign", 0, 13), ("entropy", 14, 40)]
    assert found[2] == [("entropy", 0, len(private))] and found[3] == [("entropy", 0, len(cases[3]))]


def test_time_is_linear_in_the_matches_of_a_text(docs):
    key = "0123456789abcdef01234567"

    def seconds(n):
        rows = docs([(1, " ".join(f"{key}{k:08x}" for k in range(n)))])
        started = time.time()
        assert with_secrets(rows).select(F.size("_spans").alias("n")).first().n == n
        return time.time() - started

    seconds(100)
    # 1 MB of keys; a list that is copied for each match took minutes.
    assert seconds(30_000) < 20


def test_plan_is_native(docs):
    plan = with_secrets(docs(EDGES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(docs):
    assert with_secrets(docs(EDGES).limit(0)).collect() == []
