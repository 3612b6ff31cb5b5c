import json
from collections import Counter

import pytest

from seamwright.operators import ports
from seamwright.operators.replies import Replies


def counting(folder, die=None, fail=()):
    """A model that notes each call in a file of its own; ``die``: the prompt that ends its worker the first time."""

    def model(prompt):
        import os
        import uuid

        with open(os.path.join(folder, f"call-{uuid.uuid4().hex}"), "w") as f:
            f.write(prompt)
        if prompt == die and not os.path.exists(os.path.join(folder, "died")):
            open(os.path.join(folder, "died"), "w").close()
            os._exit(3)
        if prompt in fail:
            raise RuntimeError("down")
        return prompt.upper()

    return model


def calls(folder):
    return Counter(p.read_text() for p in folder.glob("call-*"))


def frame(spark, prompts):
    return spark.createDataFrame([(i, p) for i, p in enumerate(prompts)], "id int, prompt string")


def test_each_prompt_is_asked_once_over_two_runs(spark, tmp_path):
    kept = Replies(str(tmp_path / "replies"), "m", in_flight=2, per_task=2)
    log = tmp_path / "log"
    log.mkdir()
    first = ["a", "b", "a", None, "c"]
    got = {r["id"]: (r["reply"], r["error"]) for r in ports.ask(frame(spark, first), "prompt", counting(str(log)), wait=0, replies=kept).collect()}
    assert got == {0: ("A", None), 1: ("B", None), 2: ("A", None), 3: (None, "no prompt"), 4: ("C", None)}
    assert calls(log) == {"a": 1, "b": 1, "c": 1}
    more = ports.ask(frame(spark, ["c", "d", "a"]), "prompt", counting(str(log)), wait=0, replies=kept)
    assert sorted(r["reply"] for r in more.collect()) == ["A", "C", "D"] and sorted(r["reply"] for r in more.collect()) == ["A", "C", "D"]
    assert calls(log) == {"a": 1, "b": 1, "c": 1, "d": 1}
    ports.ask(frame(spark, ["a"]), "prompt", counting(str(log)), wait=0, replies=kept.scoped(taxonomy="v2")).collect()
    ports.ask(frame(spark, ["a"]), "prompt", counting(str(log)), wait=0, replies=Replies(kept.folder, "other")).collect()
    assert calls(log)["a"] == 3
    ports.ask(frame(spark, ["b"]), "prompt", counting(str(log)), wait=0, replies=Replies(kept.folder, "m", force=True)).collect()
    assert calls(log)["b"] == 2


def test_a_killed_worker_costs_one_wave_at_most(spark, tmp_path):
    kept = Replies(str(tmp_path / "replies"), "m", in_flight=1, per_task=1)
    log = tmp_path / "log"
    log.mkdir()
    prompts = [f"p{k}" for k in range(6)]
    with pytest.raises(Exception):  # noqa: B017, PT011 - local mode doesn't repeat a task
        ports.ask(frame(spark, prompts), "prompt", counting(str(log), die="p3"), wait=0, replies=kept).collect()
    before = calls(log)
    rows = ports.ask(frame(spark, prompts), "prompt", counting(str(log), die="p3"), wait=0, replies=kept).collect()
    assert {r["prompt"]: r["reply"] for r in rows} == {p: p.upper() for p in prompts}
    again = calls(log) - Counter(prompts)
    assert again["p3"] == 1 and set(again) <= set(before) and sum(again.values()) <= 3  # what shared the wave that broke off


def test_failures_are_asked_again(spark, tmp_path):
    kept = Replies(str(tmp_path / "replies"), "m")
    log = tmp_path / "log"
    log.mkdir()
    row = ports.ask(frame(spark, ["a"]), "prompt", counting(str(log), fail={"a"}), tries=2, wait=0, replies=kept).first()
    assert row["reply"] is None and row["error"] == "RuntimeError: down"
    row = ports.ask(frame(spark, ["a"]), "prompt", counting(str(log)), wait=0, replies=kept).first()
    assert (row["reply"], row["error"]) == ("A", None) and calls(log) == {"a": 3}


def test_classification_keeps_its_replies(spark, tmp_path):
    kept = Replies(str(tmp_path / "replies"), "m")
    log = tmp_path / "log"
    log.mkdir()
    note = counting(str(log))

    def model(prompt):
        note(prompt)
        return json.dumps(dict.fromkeys(json.loads(prompt[prompt.index("["):]), "one"))

    df = spark.createDataFrame([(f"t{k}",) for k in range(10)], "term string")
    for categories, batch, n in ((["one", "two"], 4, 3), (["one", "two"], 4, 3), (["two", "one"], 4, 6), (["one"], 4, 9), (["one"], 5, 11)):
        got = ports.classify_terms(df, categories, model, batch=batch, wait=0, replies=kept).collect()
        assert len(got) == 10 and {r["category"] for r in got} == {"one"}
        assert sum(calls(log).values()) == n, (categories, batch)
