"""Fetching missing answers with retries, against fake APIs."""

import pytest
from filmgraph.operators import fetch as X


class Clock:
    def __init__(self):
        self.t = 0.0
        self.sleeps = []

    def sleep(self, s):
        self.sleeps.append(s)
        self.t += s

    def now(self):
        return self.t


def test_success_first_time():
    c = Clock()
    assert X.call_with_backoff(lambda r: "{}", "tt1", sleep=c.sleep, clock=c.now) == "{}"
    assert c.sleeps == []


def test_fail_then_succeed():
    c = Clock()
    answers = iter([None, ConnectionError(), '{"Response":"True"}'])

    def api(ref):
        a = next(answers)
        if isinstance(a, Exception):
            raise a
        return a
    assert X.call_with_backoff(api, "tt1", sleep=c.sleep, clock=c.now) == '{"Response":"True"}'
    assert c.sleeps == [1.0, 2.0]


def test_always_failing_gives_none_after_six_retries():
    c = Clock()
    calls = []

    def api(ref):
        calls.append(ref)
        raise TimeoutError()
    assert X.call_with_backoff(api, "tt1", sleep=c.sleep, clock=c.now) is None
    assert len(calls) == 7 and c.sleeps == [1.0, 2.0, 4.0, 8.0, 16.0, 32.0]


def test_wait_budget_caps_retries():
    c = Clock()
    assert X.call_with_backoff(lambda r: None, "tt1", delay=10.0, sleep=c.sleep,
                               clock=c.now) is None
    assert sum(c.sleeps) <= X.MAX_WAIT and c.sleeps == [10.0, 20.0, 40.0]


def links_df(spark):
    return spark.createDataFrame([(str(i), f"{i:07d}", None) for i in range(1, 11)],
                                 "movieId string, imdbId string, tmdbId string")


def test_fetch_missing_skips_landed_answers(spark):
    landed = spark.createDataFrame(
        [("1", "0000001", "{}"), ("2", "0000002", None)],
        "movieId string, imdbId string, response string")
    def api(ref):
        return '{"imdbID":"%s"}' % ref

    out = X.fetch_missing(links_df(spark), landed, api, partitions=3, sleep=lambda s: None)
    rows = {r["movieId"]: r["response"] for r in out.collect()}
    assert sorted(rows, key=int) == [str(i) for i in range(2, 11)]   # 2 had a null answer
    assert rows["10"] == '{"imdbID":"tt0000010"}'


def test_fetch_missing_lands_null_for_dead_ids(spark):
    def api(ref):
        if int(ref[2:]) % 2 == 0:
            raise ConnectionError()
        return "{}"
    out = X.fetch_missing(links_df(spark), None, api, partitions=2, delay=0.0,
                          sleep=lambda s: None)
    got = {int(r["movieId"]): r["response"] for r in out.collect()}
    assert all((v is None) == (k % 2 == 0) for k, v in got.items()) and len(got) == 10


def test_fetch_job_resumes_into_a_batch_folder(spark, tmp_root):
    from filmgraph.plans import load
    from filmgraph.sources import dataset as io
    io.write_csv(links_df(spark), io.dataset_path(tmp_root, "links"))

    def api(ref):
        return None if int(ref[2:]) > 5 else "{}"
    first = load.fetch_omdb(spark, tmp_root, api, partitions=2, delay=0.0, sleep=lambda s: None)
    assert len(first) == 1 and "/omdb-json/batch-" in first[0]
    second = load.fetch_omdb(spark, tmp_root, lambda ref: "{}", partitions=2, batch_links=2,
                             delay=0.0, sleep=lambda s: None)
    assert len(second) == 3 and not set(first) & set(second)      # 5 links left, about 2 a batch
    landed = io.read_omdb_responses(spark, tmp_root)
    assert landed.where("response is not null").select("movieId").distinct().count() == 10


def test_a_call_that_never_returns_ends_with_its_budget():
    import time
    began = time.monotonic()
    assert X.call_with_backoff(lambda ref: time.sleep(60), "tt1", max_wait=0.3) is None
    assert time.monotonic() - began < 5


def test_answers_make_earlier_null_rows_obsolete(spark):
    from filmgraph.operators import responses
    rows = [("1", "1", None), ("1", "1", '{"Response":"True"}'), ("2", "2", None),
            ("2", "2", None), ("3", "3", '{"Response":"False"}')]
    df = spark.createDataFrame(rows, "movieId string, imdbId string, response string")
    counts = {r["metric"]: r["n"] for r in responses.status_counts(
        responses.classify(responses.current(df))).collect()}
    assert counts == {"parse_successes": 1, "parse_failures": 1, "unfetched": 1}


def test_fetch_function_by_name():
    from filmgraph.plans import load
    assert load.named_function("os.path:basename")("a/b") == "b"
    with pytest.raises(ValueError):
        load.named_function("os.path")


def test_constants():
    assert (X.MAX_RETRIES, X.FIRST_DELAY, X.BACKOFF_BASE, X.MAX_WAIT) == (6, 1.0, 2.0, 70.0)


# ---------------------------------------------------------------- pace

def test_calls_of_all_tasks_keep_to_the_rate():
    c = Clock()
    gate = X.Gate(X.Pace(calls_per_second=4.0), tasks=2, sleep=c.sleep, clock=c.now)
    at = []
    for i in range(5):
        assert X.call_with_backoff(lambda r: at.append(c.t) or "{}", "tt1", sleep=c.sleep,
                                   clock=c.now, gate=gate) == "{}"
    assert at == [0.0, 0.5, 1.0, 1.5, 2.0]          # two tasks share four calls a second


def test_being_told_to_wait_holds_all_calls_and_is_no_failure():
    c, calls = Clock(), []
    gate = X.Gate(X.Pace(trip_after=2), sleep=c.sleep, clock=c.now)

    def api(ref):
        calls.append((ref, c.t))
        if len(calls) <= 9:
            raise X.RetryLater(3.0)
        return "{}"

    assert X.call_with_backoff(api, "tt1", sleep=c.sleep, clock=c.now, gate=gate) == "{}"
    assert [t for _, t in calls] == [3.0 * i for i in range(10)] and gate.failures == 0
    calls.clear()
    assert X.call_with_backoff(api, "tt2", sleep=c.sleep, clock=c.now, gate=gate,
                               max_wait=10.0) is None          # the budget ends it all the same
    assert len(calls) == 4


def test_an_api_that_is_down_is_left_alone_for_a_while():
    c, calls = Clock(), []
    gate = X.Gate(X.Pace(trip_after=3, cool_down=10.0), sleep=c.sleep, clock=c.now)

    def down(ref):
        calls.append(c.t)
        return None

    for ref in ("a", "b", "c", "d"):
        X.call_with_backoff(down, ref, max_retries=0, sleep=c.sleep, clock=c.now, gate=gate)
    assert calls == [0.0, 0.0, 0.0, 10.0]
    X.call_with_backoff(lambda r: "{}", "e", max_retries=0, sleep=c.sleep, clock=c.now, gate=gate)
    assert c.t == 20.0 and gate.failures == 0
    X.call_with_backoff(lambda r: "{}", "f", max_retries=0, sleep=c.sleep, clock=c.now, gate=gate)
    assert c.t == 20.0                              # closed again
    late = X.Gate(X.Pace(trip_after=1, cool_down=100.0), sleep=c.sleep, clock=c.now)
    assert X.call_with_backoff(down, "g", delay=0.0, sleep=c.sleep, clock=c.now, gate=late) is None
    assert c.t == 20.0                              # its turn would come after its budget


def test_concurrent_calls_give_the_same_rows_faster_and_resume(spark, tmp_root):
    import time

    def slow_api(ref):
        import time
        time.sleep(0.05)
        n = int(ref[2:])
        if n % 7 == 0 and time.monotonic() % 0.2 < 0.05:
            raise X.RetryLater(0.02)
        if n % 10 == 0:
            raise ConnectionError()
        return '{"imdbID":"%s"}' % ref

    from filmgraph.plans import load
    from filmgraph.sources import dataset as io
    links = spark.createDataFrame([(str(i), f"{i:07d}", None) for i in range(1, 81)],
                                  "movieId string, imdbId string, tmdbId string")
    io.write_csv(links, io.dataset_path(tmp_root, "links"))
    pace = X.Pace(concurrent=16)
    X.fetch_missing(links.limit(1), None, slow_api, partitions=1, pace=pace).collect()   # warm up
    began = time.monotonic()
    load.fetch_omdb(spark, tmp_root, slow_api, partitions=1, pace=pace, delay=0.0, max_retries=1)
    took = time.monotonic() - began
    landed = {r["movieId"]: r["response"] for r in io.read_omdb_responses(spark, tmp_root).collect()}
    assert len(landed) == 80 and took < 80 * 0.05
    for i in range(1, 81):
        want = None if i % 10 == 0 else '{"imdbID":"tt%07d"}' % i
        assert landed[str(i)] == want
    again = load.fetch_omdb(spark, tmp_root, lambda ref: "{}", partitions=2, pace=pace)
    todo = spark.read.json(again[0]) if again else None
    assert todo.count() == 8                        # only the links without an answer


def test_sketches_of_loads_add_up(spark, tmp_root):
    from filmgraph.operators import edges as E
    from filmgraph.plans import load
    kinds = ("directors", "writers", "actors", "languages", "countries")
    schema = "movieId long, " + ", ".join(f"{k} array<string>" for k in kinds)
    root = f"{tmp_root}/graph"
    for part in range(3):
        rows = [(part * 1000 + i, [f"D {i % 40}"], [f"W {part}-{i} (story)", f"W {part}-{i}"],
                 [f"A {j}" for j in range(i, i + 5)], [], None) for i in range(400)]
        credits = E.credit_items(spark.createDataFrame(rows, schema))
        load.write_entity_sketches(credits, root)
        load.write_entity_sketches(credits, root)              # a load that ran twice
    got = {r["kind"]: (r["n_raw"], r["n_names"]) for r in load.entity_estimates(spark, root).collect()}
    assert got["directors"] == (40, 40)
    assert abs(got["writers"][0] - 2400) < 72 and abs(got["writers"][1] - 1200) < 36
    assert abs(got["actors"][0] - 404) < 13 and "languages" not in got


def test_cooling_times_pass_with_a_sleep_that_does_not_wait(spark):
    """Without a clock, the gate's waits end when the given sleep returns; they were spun away in real time."""
    import time
    links = spark.createDataFrame([(str(i), f"{i:07d}", None) for i in range(1, 13)],
                                  "movieId string, imdbId string, tmdbId string")

    def api(ref):
        if int(ref[2:]) % 4:
            raise ConnectionError("unavailable")
        return "{}"

    X.fetch_missing(links.limit(1), None, lambda ref: "{}", partitions=1).collect()   # warm up
    began = time.monotonic()
    out = X.fetch_missing(links, None, api, partitions=1, delay=0.0, sleep=lambda s: None,
                          pace=X.Pace(trip_after=2, cool_down=8.0))
    got = {int(r["movieId"]): r["response"] for r in out.collect()}
    assert got == {i: None if i % 4 else "{}" for i in range(1, 13)}
    assert time.monotonic() - began < 30


def test_a_sleep_that_waits_does_not_put_the_clock_forward():
    import time
    line = X.Timeline(time.sleep)
    line.sleep(0.02)
    assert 0.0 <= line.ahead < 0.02
    line = X.Timeline(lambda s: None)
    began = line.clock()
    line.sleep(50.0)
    assert 50.0 <= line.clock() - began < 60.0
