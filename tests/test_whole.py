"""Nothing is cut, and nothing that failed goes on."""

import pytest

from loreweave.functions.hooks import echo_client
from loreweave.operators.chat import ends_of_histories
from loreweave.plans.bakeoff import model_bakeoff, rated_answers
from loreweave.session import need_one_machine


def test_end_of_a_long_history(spark):
    long = "x" * 1_048_570 + "end of it"
    rows = [(1, 0, long), (1, 1, "[b]short"), (2, 0, "[a]"), (2, 1, None), (2, 2, "[b]"), (3, 0, None)]
    rows += [(4, i, "") for i in range(1_000)] + [(5, i, f"[{i}]") for i in range(1_000)]
    got = {r.conv_id: r.tail for r in ends_of_histories(spark.createDataFrame(rows, "conv_id long, turn long, line string"), 512).collect()}
    want = {}
    for c, _, line in rows:
        if line is not None:
            want.setdefault(c, []).append(line)
    assert got == {c: "\n".join(lines)[-512:] for c, lines in want.items()}
    assert len(got[1]) == 512


def test_failed_answers_are_rejected_and_never_rated(spark):
    def always_fails():
        def ask(prompts):
            raise RuntimeError("no model")

        return ask

    def fails_on_b():
        def ask(prompts):
            if any(p.startswith("b") for p in prompts):
                raise RuntimeError("no model b")
            return ["fine" for _ in prompts]

        return ask

    def seven():
        return lambda prompts: ["7" for _ in prompts]

    questions = spark.createDataFrame([(1, "why"), (2, "how")], "qid long, question string")
    models = spark.createDataFrame([("a",), ("b",)], "name string")
    rated, rejected = rated_answers(questions, models, fails_on_b, seven)
    assert sorted((r.qid, r.model, r.rating_text) for r in rated.collect()) == [(1, "a", "7"), (2, "a", "7")]
    assert sorted((r.qid, r.model, r.step) for r in rejected.collect()) == [(1, "b", "answer"), (2, "b", "answer")]
    wide, ratings, rejected = model_bakeoff(questions, models, always_fails, seven)
    assert ratings.count() == wide.count() == 0 and rejected.count() == 4
    _, ratings, rejected = model_bakeoff(questions, models, echo_client, always_fails)
    assert ratings.count() == 0 and {r.step for r in rejected.collect()} == {"rating"}


@pytest.mark.parametrize("master, fine", [("local", True), ("local[8]", True), ("local-cluster[3,2,1024]", False), ("spark://host:7077", False), ("yarn", False)])
def test_a_cluster_must_name_its_shared_folder(master, fine):
    if fine:
        need_one_machine(master)
    else:
        with pytest.raises(ValueError):
            need_one_machine(master)
