"""Submission outcome classification (truth table incl. the substring quirk)."""

from ingestflow.operators.submit import classify_submission, load_requests, submit_rounds


def test_truth_table(spark):
    rows = [("1", None, None), ("2", "backoff", "slow down"),
            ("3", "response", "HTTP Status: 400"), ("4", "response", "HTTP Status: 404"),
            ("5", "response", "HTTP Status: 429"), ("6", "response", "HTTP Status: 500"),
            ("7", "response", "HTTP Status: 1500"), ("8", "response", "reset"),
            ("9", "other", "boom")]
    df = spark.createDataFrame(rows, "request_id string, kind string, message string")
    out = {r.request_id: (r.route, r.response_code, r.error_message)
           for r in classify_submission(df).collect()}
    assert out == {
        "1": ("success", "200", None), "2": ("retry", None, "slow down"),
        "3": ("failure", "400", "HTTP Status: 400"), "4": ("failure", "404", "HTTP Status: 404"),
        "5": ("retry", "429", "HTTP Status: 429"), "6": ("retry", "500", "HTTP Status: 500"),
        "7": ("retry", "1500", "HTTP Status: 1500"), "8": ("failure", "0", "reset"),
        "9": ("failure", None, "boom")}


def test_rounds(spark):
    r1 = spark.createDataFrame([("a", "backoff", "x"), ("b", None, None)],
                               "request_id string, kind string, message string")
    r2 = spark.createDataFrame([("a", None, None), ("b", "other", "late")],
                               "request_id string, kind string, message string")
    out = {r.request_id: (r.route, r["round"]) for r in submit_rounds([r1, r2]).collect()}
    assert out == {"a": ("success", 2), "b": ("success", 1)}


def test_load_requests_default_file(spark):
    df = spark.createDataFrame([({"filename": "x.csv", "p": "db.s.p"},)],
                               "attributes map<string,string>")
    (r,) = load_requests(df, "${p}").collect()
    assert (r.pipe, r.file) == ("db.s.p", "x.csv")


def test_a_retried_request_without_an_answer_stays(spark):
    """No request is lost: unanswered ones stay on retry with the round of their last outcome."""
    schema = "request_id string, kind string, message string"
    r1 = spark.createDataFrame([("a", "backoff", "x"), ("b", None, None), ("c", "backoff", "y"),
                                ("d", "backoff", "z"), ("e", "backoff", "w")], schema)
    r2 = spark.createDataFrame([("a", None, None), ("d", "response", "HTTP Status: 500")], schema)
    r3 = spark.createDataFrame([("e", "other", "boom"), ("a", "other", "late"), ("b", "other", "late")], schema)
    out = submit_rounds([r1, r2, r3]).collect()
    assert {r.request_id: (r.route, r["round"], r.response_code) for r in out} == {
        "a": ("success", 2, "200"), "b": ("success", 1, "200"), "c": ("retry", 1, None),
        "d": ("retry", 2, "500"), "e": ("failure", 3, None)}
    assert len(out) == 5
