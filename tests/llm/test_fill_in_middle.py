import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortkit.llm import fill_in_middle as fim

SCHEMA = "doc_id bigint, text string, n bigint, form string, output string"


def by_definition(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    x, y, z = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", a, b - a, f"<P>{x}<S>{z}<M>{y}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("<>PSM aé中🙂\n"), st.characters(codec="utf-8")), max_size=60), st.integers(-5, 10**12))
def test_one_text(text, doc_id):
    out, form, n, a, m = fim.transform(text.encode(), doc_id)
    assert (n, form, a, m, out.decode()) == by_definition(doc_id, text)
    assert fim.restore(out, form) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=40), st.data())
def test_rotation(data, draw):
    a, b, c = sorted(draw.draw(st.integers(0, len(data))) for _ in range(3))
    buf = bytearray(data)
    fim.rotate(buf, a, b, c)
    assert bytes(buf) == data[:a] + data[b:c] + data[a:b] + data[c:]
    fim.rotate(buf, a, a + c - b, c)
    assert bytes(buf) == data


def rows():
    rng = random.Random(5)
    alphabet = "abc <>PSM\né中🙂"
    out = [(k, "".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))) for k in range(400)]
    return out + [(1000, None), (1001, ""), (None, "no id"), (None, None), (1002, "a<S>b"), (1003, "long é " * 100_000), (7, "again"), (7, "again"), (-3, "below zero 中")]


def test_table_and_restore(spark):
    data = rows()
    df = spark.createDataFrame([(i, t, 0, "x", "y") for i, t in data], SCHEMA)
    formed = fim.fill_in_middle(df)
    got = sorted(formed.collect(), key=str)
    want = sorted(((i, *by_definition(i, t or "")) for i, t in data), key=lambda r: str(r))
    assert sorted(map(lambda r: str(tuple(r)), got)) == sorted(map(str, want))
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    back = fim.restore_texts(formed.withColumn("text", F.lit("not read")).withColumn("restored", F.lit("clash")))
    assert sorted(r.restored for r in back.collect()) == sorted(t or "" for _, t in data)


def test_parameters_and_empty_table(spark):
    df = spark.createDataFrame([(k, "some text here") for k in range(200)], "doc_id bigint, text string")
    assert {r.form for r in fim.fill_in_middle(df, fim_percent=0).collect()} == {"plain"}
    assert {r.form for r in fim.fill_in_middle(df, fim_percent=100, spm_percent=100).collect()} == {"spm"}
    assert fim.fill_in_middle(df, seed=2).exceptAll(fim.fill_in_middle(df)).count() > 0
    none = spark.createDataFrame([], SCHEMA)
    assert fim.restore_texts(fim.fill_in_middle(none)).count() == 0
