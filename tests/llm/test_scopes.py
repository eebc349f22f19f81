"""Complements link within their whole scope, however long the parts or the text between them."""

from tidelog.llm import secrets


def test_complements_far_apart_in_one_scope(spark):
    token, url = "token: " + "Zx" * 450, "https://" + "h/" * 250
    gap = " word" * 600
    texts = [f"{token} login: bob", f"{url} pwd = hunter2", f"login: bob{gap} pwd = hunter2", f"login: bob{gap}\n\n{gap} pwd = hunter2"]
    rows = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[s.kind for s in r.secret_spans] for r in rows] == [["assign", "identifier"], ["weak"], ["identifier", "weak"], []]


def test_redaction_takes_the_far_password(spark):
    docs = spark.createDataFrame([(1, "login: bob" + " word" * 600 + " pwd = hunter2", 0)], "doc_id long, text string, n_chars long")
    assert "hunter2" not in secrets.redact(docs).first().text
