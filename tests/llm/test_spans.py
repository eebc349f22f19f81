import hashlib
import re

from tidelog.llm import pii, secrets
from tidelog.llm.common import durable

A = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    out = [(m.start(), 0, m.end(), "assign") for m in A.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32])


CASES = [
    None, "", "password: hunter2hunter2", "PASSWORD=short token: abcdefgh12", "token: secret=abcdefgh12", "password=token:abcdefgh", "😀 api_key = 'ABCDEFGH' é AKIA" + "Z" * 12 + "a",
    "AKIAAKIA" + "9" * 9, "AKIASHORT", "0" * 31, "g" + "a" * 40 + "G" + "1" * 32, 'secret" : "' + "x" * 9, "token\n=abcdefghij", "apikey=aaaaaaaa" * 300, "f" * 50000,
]


def shown(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def test_base_spans_by_brute_force(spark, docs, odd_docs, no_docs):
    cases = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    for df in (cases, docs, odd_docs):
        want = sorted(((r.doc_id, hashlib.sha256(shown(base(r.text or "")).encode()).hexdigest()) for r in df.collect()), key=str)
        rows = secrets.digest(df).collect()
        assert sorted(((r.doc_id, r.base_sha256) for r in rows), key=str) == want
    assert secrets.digest(no_docs).count() == 0
    got = {r.doc_id: r for r in secrets.digest(cases).collect()}
    for i, text in enumerate(CASES):
        spans = base(text or "")
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert set(filter(None, shown(spans).split(","))) <= set(got[i].spans.split(","))


def spans_of(spark, *texts):
    rows = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    return [[(s.kind, t[s.start : s.end]) for s in r.secret_spans] for r, t in zip(rows, texts)]


def test_weak_parts_need_their_complements(spark):
    far = " word" * 120
    login, pwd, url = "login: bob", "pwd = hunter2", "https://db.example.org/x"
    both = [("identifier", login), ("weak", pwd)]
    found = spans_of(
        spark, login, pwd, url, f"{login} {pwd}", f"{login}{far} {pwd}", f"{login}\n\n{pwd}", f"{login}\n \t\n{pwd}", f"{pwd} {url}", f"{login} {url}",
        f"{login} {pwd} {url}", "user = amy, token: abc", "login: bob password: longenough1", "same text login: bob pwd = hunter2", "same text login: bob pwd = hunter2",
    )
    assert found == [
        [], [], [], both, both, [], [], [("weak", pwd)], [], [*both, ("endpoint", url)], [("identifier", "user = amy"), ("weak", "token: abc")],
        [("identifier", login), ("assign", "password: longenough1")], both, both,
    ]


def test_redaction(spark, odd_docs):
    docs = spark.createDataFrame([(1, "a token = abcdefgh99 b AKIA" + "A" * 20 + " login: x1y pin: 1234", 5), (2, "clean", 5), (3, None, None)], "doc_id long, text string, n_chars long")
    rows = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert rows[1].text == "a [secret] b [secret] [secret] [secret]" and rows[1].n_chars == len(rows[1].text)
    assert rows[2].text == "clean" and rows[3].text is None
    assert secrets.redact(odd_docs).columns == odd_docs.columns and secrets.redact(odd_docs).count() == odd_docs.count()


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


VALUES = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "+1 (017) 555-7713", "97.51.17.173", "2024-02-29", "31.12.1999", "01/02/2003", "a.B9+x@mail7.example.com", "123-45-6789"]
LEFT = ["010.001.002.003", "4111111111111112", "300.1.1.1", "2023-02-30", "0000000000000000", "1.2.3.4.5", "666-12-1234", "12345", "a@b", "3.14", "99.99.2020"]


def test_values_are_permuted_in_their_format(spark):
    texts = [*VALUES, *LEFT, " | ".join(VALUES), None, "", "4111111111111111 4111111111111111", "x" * 50000, "9" * 5000, "a.a@" * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in pii.pseudonymise(docs).collect()}
    for i, v in enumerate(VALUES):
        new = out[i].text
        assert new != v and len(out[i].pii) == 1
        if "@" in v:
            assert new.endswith("@mail7.example.com")
        if out[i].pii[0] != "ip":
            shape = lambda s: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", s)))
            assert shape(new) == shape(v)
        if out[i].pii[0] == "card":
            assert luhn(new)
    assert [out[len(VALUES) + k].text for k in range(len(LEFT))] == LEFT
    n = len(VALUES) + len(LEFT)
    assert out[n].text == " | ".join(out[i].text for i in range(len(VALUES)))  # one value, one pseudonym
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(out[0].text) == digits(out[1].text) == out[2].text and out[n + 3].text == f"{out[2].text} {out[2].text}"
    assert out[n + 1].text is None and out[n + 2].text == ""
    back = pii.pseudonymise(pii.pseudonymise(docs, "k"), "k", reveal=True).collect()
    assert {r.doc_id: r.text for r in back} == dict(enumerate(texts))
    assert pii.pseudonymise(docs, "other").where("doc_id = 0").first().text != out[0].text


def test_feistel_is_a_permutation(spark):
    from pyspark.sql import functions as F

    size = [F.lit(s).cast("long") for s in (7, 11)]
    df = spark.range(77).select(pii.feistel(F.floor(F.col("id") / 11), F.col("id") % 11, *size, "key", "test").alias("p"))
    got = sorted(r.p.a * 11 + r.p.b for r in df.collect())
    assert got == list(range(77))


def test_pii_round_trip_on_the_table(docs, odd_docs, no_docs):
    for df in (docs, odd_docs):
        hidden = pii.pseudonymise(df)
        assert [c for c in hidden.columns if c != "pii"] == df.columns
        key = lambda rows: sorted(((str(r.doc_id), r.text) for r in rows), key=str)
        assert key(pii.pseudonymise(hidden, reveal=True).collect()) == key(df.collect())
    assert pii.pseudonymise(no_docs).count() == 0


def plain_feistel(a, b, sizes, key, kind):
    """The permutation again, in plain Python."""
    for r in range(pii.ROUNDS):
        size, other = (sizes[0], b) if r % 2 == 0 else (sizes[1], a)
        shift = int(hashlib.sha256("|".join(map(str, (key, kind, r, size, other))).encode()).hexdigest()[:15], 16)
        a, b = ((a + shift) % size, b) if r % 2 == 0 else (a, (b + shift) % size)
    return a, b


def test_feistel_agrees_with_plain_python(spark):
    from pyspark.sql import functions as F

    sizes = (898, 989901)
    df = spark.range(500).selectExpr("id * 7 % 898 as a", "id * 1999 % 989901 as b")
    rows = df.select("a", "b", pii.feistel(F.col("a"), F.col("b"), *[F.lit(s).cast("long") for s in sizes], "k", "national_id").alias("p")).collect()
    assert all((r.p.a, r.p.b) == plain_feistel(r.a, r.b, sizes, "k", "national_id") for r in rows)
    one = pii.pseudonymise(spark.createDataFrame([(1, "667-01-0001")], "doc_id long, text string"), "k").first().text
    a, b = plain_feistel(665, 0, sizes, "k", "national_id")
    assert one == f"{a + 1 + (a + 1 >= 666):03d}-{b // 9999 + 1:02d}-{b % 9999 + 1:04d}"


def test_random_values_of_every_kind_come_back(spark):
    n = 100_000
    r = lambda k, m: f"pmod(xxhash64(id, {k}), {m})"
    area, card = f"1 + {r(1, 898)}", f"lpad({r(4, 10**15)}, 15, '0')"
    kinds = {
        "national_id": f"format_string('%03d-%02d-%04d', if({area} >= 666, {area} + 1, {area}), 1 + {r(2, 99)}, 1 + {r(3, 9999)})",
        "card": f"concat({card}, (10 - {luhn_sql(card)}) % 10)",
        "ip": "concat_ws('.', " + ", ".join(r(k, 256) for k in range(5, 9)) + ")",
        "date": f"date_format(date_add(date'1800-01-01', cast({r(9, 146097)} as int)), 'yyyy-MM-dd')",
        "phone": f"format_string('(%03d) %03d-%04d', {r(10, 1000)}, {r(11, 1000)}, {r(12, 10000)})",
        "email": f"concat(substr(md5(cast(id as string)), 1, cast(1 + {r(13, 20)} as int)), '@example.org')",
    }
    values = spark.range(0, n, 1, 32).selectExpr("id as doc_id", "stack(6, " + ", ".join(f"'{k}', {v}" for k, v in kinds.items()) + ") as (kind, text)").selectExpr("*", "text as before")
    hidden = durable(pii.pseudonymise(durable(values))).selectExpr("*", "pii as first", "text as hidden")
    back = durable(pii.pseudonymise(hidden, reveal=True))
    bad = back.where("first != array(kind) or pii != array(kind) or text != before")
    assert bad.select("kind", "before", "hidden", "text", "first", "pii").limit(5).collect() == [] and back.count() == 6 * n
    assert back.where("hidden = before").count() < 600  # only short local parts and chance


def luhn_sql(body):
    """Luhn sum of 15 digits before their check digit, as SQL."""
    return "(" + " + ".join(f"int(2 * substr({body}, {k}, 1) / 10) + 2 * substr({body}, {k}, 1) % 10" if k % 2 else f"int(substr({body}, {k}, 1))" for k in range(1, 16)) + ") % 10"


def test_long_texts_and_names_that_clash(spark, odd_docs):
    docs = spark.range(1).selectExpr("id as doc_id", "concat(repeat('word ', 2000000), '\n\nlogin: bob pwd = hunter2 ', repeat('x: 1 ', 100000)) as text", "'own' as text_or_empty", "'own' as hits", "'own' as _text", "1L as n_chars", "'own' as redacted_text")
    row = secrets.redact(docs).first()
    assert row.text.startswith("word " * 2000000 + "\n\n[secret] [secret] x: 1") and (row.text_or_empty, row._text, row.redacted_text) == ("own",) * 3
    assert [s.start for s in secrets.scan(docs).first().secret_spans] == [10_000_002, 10_000_013]
    many = spark.range(1).selectExpr("id as doc_id", "repeat('token: abcdefgh12 ', 20000) as text")
    spans = secrets.scan(many).first().secret_spans
    assert len(spans) == 20000 and all((s.start, s.end) == (18 * k, 18 * k + 17) for k, s in enumerate(spans))
    assert pii.pseudonymise(docs).first().hits == "own"
