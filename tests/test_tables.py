import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyroom import schemas
from tallyroom.operators import profiling, tables


def test_registry_keeps_first_and_takes_latest(frame):
    uploads = frame(
        "id long, user_id long, filename string, file_type string, topic string, language string, text_content string, created_at string",
        (5, 1, " b.txt ", ".txt", "old", "en", "same", "2024-01-01T00:00:00"),
        (6, 2, "c.txt", ".txt", " new ", "fr", "same", "2024-01-02T00:00:00"),
        (7, 3, "d.txt", ".txt", "other", "en", "different", "2024-01-02T00:00:00"))
    got = {r["id"]: r for r in tables.document_registry(uploads).collect()}
    assert set(got) == {5, 7}
    first = got[5]
    assert (first["user_id"], first["filename"], first["topic"], first["language"], first["usage_count"], first["updated_at"]) == (
        1, "b.txt", "new", "fr", 2, "2024-01-02T00:00:00")
    assert sorted(rows(tables.registry_texts(tables.document_registry(uploads), uploads), "id", "text_content")) == [
        (5, "same"), (7, "different")]


SUMMARY = ("id long, user_id long, document_id long, method string, mode string, target_language string, summary_text string, "
           "key_insights string, hierarchy_json string, created_at string")


def test_summary_cache_and_propagation(frame):
    stored = frame(SUMMARY, (1, 7, 3, "tfidf", "brief", "en", "first", "[]", "{}", "2024-01-01"),
                   (2, 7, 3, "tfidf", "brief", "en", "second", "[]", "{}", "2024-01-02"))
    latest = tables.latest_summaries(stored).first()
    assert (latest["id"], latest["summary_text"], latest["created_at"]) == (1, "second", "2024-01-01")
    requests = frame("user_id long, document_id long, method string, mode string, target_language string",
                     (7, 3, "tfidf", "brief", "en"), (7, 3, "tfidf", "brief", "fr"))
    assert rows(tables.cached_summaries(requests, stored), "summary_text") == [("second",)]
    assert rows(tables.summary_misses(requests, stored), "target_language") == [("fr",)]
    quiz = frame("id long, user_id long, document_id long, summary_cache string", (1, 7, 3, None), (2, 7, 4, "old"), (3, 8, 3, None))
    assert sorted(rows(tables.propagate_summaries(quiz, stored), "id", "summary_cache"), key=str) == [
        (1, "second"), (2, "old"), (3, None)]


def _replay(start, misses):
    for missed in misses:
        start = max(0.0, start - 0.05) if missed else min(1.0, start + 0.02)
    return start


@pytest.mark.parametrize("start, misses", [
    (0.9, [False] * 9), (0.12, [True] * 5), (0.5, [True, False] * 40), (0.02, [True, False, True, False, False]),
    (0.98, [False, False, True, False, False, True, True]), (0.0, [True] * 3 + [False] * 60 + [True] * 2), (0.4, []),
])
def test_quality_fold_equals_replay(frame, start, misses):
    questions = frame("id long, quality_score double, struggle_count long, last_used_at string", (1, start, 2, "before"))
    attempts = frame("question_id long, attempt_id long, attempted_at string, struggled boolean", *[
        (1, i, f"2024-01-{1 + i // 20:02d}T{i // 5 % 24:02d}:{i % 3:02d}:00", m) for i, m in enumerate(misses)])
    order = sorted(range(len(misses)), key=lambda i: (1 + i // 20, i // 5 % 24, i % 3, i))
    got = tables.update_question_quality(questions, attempts.repartition(3)).first()
    assert got["quality_score"] == pytest.approx(_replay(start, [misses[i] for i in order]), abs=1e-6)
    assert got["struggle_count"] == 2 + sum(misses)
    assert (got["last_used_at"] == "before") == (not misses)


def test_cached_questions_limit_before_filter(frame):
    bank = frame(
        "id long, document_id long, difficulty_level string, quality_score double, created_at string, options_json string, "
        "question_text string, answer_text string, question_type string",
        (1, 1, "easy", 0.9, "2024", '["a"]', "q1", "a", "m"), (2, 1, "easy", 0.8, "2024", '["a","b"]', "q2", "a", "m"),
        (3, 1, "easy", 0.7, "2024", '["a","b"]', "q3", "a", "m"), (4, 1, "hard", 0.1, "2024", "broken", "q4", "a", "m"))
    got = tables.cached_questions(bank, 2)
    assert rows(got, "id", "question", "options") == [(2, "q2", ["a", "b"])]


def test_missing_columns_get_defaults(frame):
    old = frame("id long, user_id long, event_data string", (1, 7, "{}"))
    got = tables.add_missing_columns(old, "events")
    assert set(schemas.ADDED_COLUMNS["events"]) <= set(got.columns)
    assert rows(got, "duration_seconds", "engagement_score", "topics_json", "event_data") == [(0, 0.0, None, "{}")]
    assert tables.add_missing_columns(got, "events").columns == got.columns


def test_merge_keeps_order_and_unique_topics(frame):
    files = frame("batch_id long, position long, filename string, topic string, language string, text_content string",
                  (1, 2, "b.txt", "t", "fr", "B"), (1, 1, "a.txt", "t", "en", "A"), (1, 3, "c.txt", "u", "en", "C"))
    got = tables.merge_uploads(files).first()
    assert (got["filename"], got["topic"], got["language"]) == ("a.txt + b.txt + c.txt", "t, u", "en")
    assert got["text_content"].split("\n\n\n")[1] == "===== DOCUMENT: b.txt =====\n\nB"


def test_long_batches_come_in_parts(spark, frame):
    """A batch of 5,000 files and one of uploads without a batch: whole texts, in order, none refused."""
    many = spark.range(5000).selectExpr("7L as batch_id", "id as position", "concat('f', id) as filename", "'t' as topic", "'en' as language",
                                        "repeat('x', cast(id % 50 as int)) as text_content")
    loose = frame("batch_id long, position long, filename string, topic string, language string, text_content string",
                  (None, 1, "a", "t", "en", "A" * 30), (None, 1, "b", "t", "en", None), (None, 2, "c", "u", "fr", "C" * 5000), (None, 3, "d", "u", "fr", ""))
    merged = tables.merge_uploads(many.union(loose).repartition(5), most_bytes=1000).orderBy("batch_id", "part").collect()
    for batch, source in ((7, many), (None, loose)):
        own = [r for r in merged if r["batch_id"] == batch]
        assert [r["part"] for r in own] == list(range(len(own))) and len(own) > 1
        files = source.orderBy("position", "filename").collect()
        assert " + ".join(r["filename"] for r in own) == " + ".join(r["filename"] for r in files)
        texts = [f"===== DOCUMENT: {f['filename']} =====\n\n{f['text_content']}" for f in files if f["text_content"] is not None]
        assert "\n\n\n".join(r["text_content"] for r in own if r["text_content"]) == "\n\n\n".join(texts)
        assert sum(r["n_files"] for r in own) == len(files)
    assert len(tables.merge_uploads(many).collect()) == 1


def test_event_rows(frame):
    activities = frame("user_id string, event_type string, created_at string", (None, "a", "x"), ("", "a", "x"), ("guest", "a", "x"), ("7", "a", "x"))
    got = tables.event_rows(activities).collect()
    assert [r["user_id"] for r in got] == [None, None, None, 7]
    assert (got[0]["activity_type"], got[0]["metadata_json"], got[0]["topics_json"], got[0]["duration_seconds"]) == ("a", "{}", "[]", 0)


def test_registration(frame):
    users = frame("full_name string, email string", (" A ", "a@b.co"), ("Al", " Al@Example.ORG "), ("Al", "al@example"), ("Al", None))
    got = rows(tables.registration_checks(users), "email", "name_ok", "email_ok")
    assert got == [("a@b.co", False, True), ("al@example.org", True, True), ("al@example", True, False), (None, True, None)]


def test_lookup_hides_the_password(frame):
    users = frame("id long, email string, password_hash string", (1, "a", "secret"), (2, "b", "secret"))
    assert rows(tables.lookup(users, 2)) == [(2, "b")]


def test_new_rows(frame, spark):
    sessions = frame("title string, topic string, created_at string", (" t ", " x ", "2024"))
    assert rows(tables.session_rows(sessions), "title", "topic", "updated_at") == [("t", "x", "2024")]
    messages = frame("role string, retrieval_metadata map<string,string>", (" user ", {"a": "1"}), ("bot", None))
    assert rows(tables.message_rows(messages)) == [("user", '{"a":"1"}'), ("bot", "{}")]
    ids = [r["id"] for r in tables.with_ids(spark.range(100).drop("id").repartition(5), 1000).collect()]
    assert len(set(ids)) == 100 and min(ids) >= 1000


# ---- profiling ----------------------------------------------------------------------


def test_profile_counts_missing_and_duplicates(frame):
    data = frame("a int, b string, c double", (1, "x", 1.0), (1, "x", 1.0), (None, None, float("nan")), (2, None, 2.0))
    got = profiling.profile(data).first()
    assert (got["rows"], got["columns"], got["missing_cells"], got["duplicate_rows"]) == (4, 3, 4, 1)
    assert (got["numeric_columns"], got["other_columns"]) == ("a,c", "b")


def test_numeric_summary_modes(frame):
    data = frame("a double, s string", *[(float(i), "x") for i in range(1, 101)], (None, None), (float("nan"), None))
    exact = profiling.numeric_summary(data).first()
    assert (exact["count"], exact["q25"], exact["median"], exact["q75"], exact["missing"]) == (100, 25.75, 50.5, 75.25, 2)
    sketch = profiling.numeric_summary(data, exact_quantiles=False).first()
    assert abs(sketch["q50"] - 50.5) <= 1
    with pytest.raises(ValueError):
        profiling.numeric_summary(data.select("s"))


@pytest.mark.parametrize("values", [
    [3.0], [1.0, 2.0], [5.0] * 40 + [1.0, 9.0], [float(i * 7919 % 1009) / 3 for i in range(1500)],
    [float(i % 3) for i in range(1000)] + [float("inf"), float("-inf")], [-1e300, 0.0, 1e300],
])
def test_exact_quantiles_equal_the_sorted_list(frame, values):
    data = frame("a double, b double", *[(v, None) for v in values], (float("nan"), None))
    got = {r["column"]: r["q"] for r in profiling.exact_quantile_arrays(
        data.repartition(5), ["a", "b"], [0.0, 0.25, 0.5, 0.75, 1.0], ranges=20).collect()}
    assert set(got) == {"a"}
    ordered = sorted(values)
    for q, value in zip([0.0, 0.25, 0.5, 0.75, 1.0], got["a"]):
        h = (len(ordered) - 1) * q
        low, high = ordered[int(h)], ordered[min(int(h) + 1, len(ordered) - 1)]
        expected = low if h == int(h) else low + (high - low) * (h - int(h))
        assert value == pytest.approx(expected)


def test_validation(frame):
    data = frame("g string, v double", ("a", 1.0), (None, 2.0), ("a", 3.0))
    assert rows(profiling.aggregate_metrics(data, "g", "v", "sum")) == [("a", 4.0), (None, 2.0)]
    for args in (("no", "v", "sum"), ("g", "no", "sum"), ("g", "v", "median")):
        with pytest.raises(ValueError):
            profiling.aggregate_metrics(data, *args)
    with pytest.raises(ValueError):
        profiling.detect_anomalies(data, "v", 0)
    with pytest.raises(ValueError):
        profiling.build_time_series(data, "no", "v")
    with pytest.raises(ValueError):
        profiling.correlation_matrix(data)


def test_anomalies_in_text_numbers(frame):
    data = frame("v string", *[(str(i % 3),) for i in range(30)], ("100",), ("text",), (None,), ("NaN",))
    values = [float(i % 3) for i in range(30)] + [100.0]
    expected = round((100 - statistics.mean(values)) / statistics.stdev(values), 2)
    assert rows(profiling.detect_anomalies(data, "v")) == [("100", expected)]
    flat = frame("v double", (1.0,), (1.0,), (1.0,))
    assert profiling.detect_anomalies(flat, "v", 0.1).isEmpty()
    assert profiling.detect_anomalies(flat.limit(1), "v", 0.1).isEmpty()


def test_correlation_over_pairwise_complete_rows(frame):
    data = frame("a double, b double", (1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 100.0), (4.0, None), (5.0, float("nan")))
    got = {(r["column_a"], r["column_b"]): r["correlation"] for r in profiling.correlation_matrix(data).collect()}
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(1.0) and got[("a", "a")] == pytest.approx(1.0)


def test_time_column_needs_a_third(frame):
    data = frame("n int, few string, some string", *[
        (i, "2024-01-01" if i < 3 else "x", "2024-02-03" if i < 4 else "y") for i in range(12)])
    assert profiling.infer_time_column(data) == "some"
    assert profiling.infer_time_series(data.select("n"))[0] is None
    name, parsed = profiling.infer_time_series(data)
    assert parsed.where(F.col(name).isNotNull()).count() == 4
    series = profiling.build_time_series(data, "some", "n")
    assert rows(series) == [("2024-02", 6)]
    assert profiling.build_time_series(data.where("n > 5"), "some", "n").isEmpty()
