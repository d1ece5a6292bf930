import math
import random

import pytest

from loomline.operators import telemetry


def test_parse_good_and_broken_lines(spark):
    lines = [
        "iter 10: loss 2.5000, time 812.34ms, mfu -100.00%",
        "iter 10: loss x, time 812.34ms, mfu 3%",
        "step 250: train loss 1.7000, val loss 1.9000",
        "step 250: train loss 1.7000",
        "\rstep 00012 (1.5%) | loss: 3.141590 | lrm: 1.00 | dt: 179000ms | tok/sec: 1,730 | mfu: 7.1% | epoch: 1 | remaining: 86000s    ",
        "step 12 (1.5%) | loss: 3.1",
        "val_bpb:          0.000812",
        "val_bpb 0.000812",
        "step 1: train loss nan, val loss inf",
        "",
        "Killed: 9",
        "Error: OOM",
        "depth:            8",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, line string")
    rows = {r.i: r for r in telemetry.parse_run_log(df).collect()}
    assert [rows[i]["shape"] for i in range(13)] == [
        "iter", None, "eval", None, "step", None, "summary", None, "eval", None, None, None, "summary"]
    assert (rows[0].step, rows[0].loss, rows[0].time_ms, rows[0].mfu) == (10, 2.5, 812.34, -100.0)
    assert (rows[2].train_loss, rows[2].val_loss) == (1.7, 1.9)
    assert (rows[4].step, rows[4].tok_per_sec, rows[4].epoch, rows[4].remaining_s) == (12, 1730, 1, 86000.0)
    assert (rows[6].key, rows[6]["value"]) == ("val_bpb", "0.000812")
    assert math.isnan(rows[8].train_loss) and math.isinf(rows[8].val_loss)
    counts = {r["shape"]: r.n_lines for r in telemetry.log_shape_counts(telemetry.parse_run_log(df)).collect()}
    assert counts["unparsed"] == 7


def loop(values, beta=0.9):
    smooth, out = 0.0, []
    for step, loss in enumerate(values):
        if math.isnan(loss) or loss > 100:
            return out + [None]
        smooth = beta * smooth + (1 - beta) * loss
        out.append(smooth / (1 - beta ** (step + 1)))
    return out


@pytest.mark.parametrize("beta,width", [(0.9, 3), (0.9, 64), (0.9, 512), (0.01, 512), (0.99, 200)])
def test_smoothed_loss_equals_the_loop(spark, beta, width):
    rng = random.Random(2)
    runs = {
        "hot": [rng.random() * 9 for _ in range(1500)],
        "nan": [1.0, 2.0, float("nan"), 3.0],
        "high": [5.0] * 70 + [100.5, 1.0, 1.0],
        "edge": [100.0, 1.0],
        "first": [500.0, 1.0],
    }
    rows = [(run, step, loss) for run, losses in runs.items() for step, loss in enumerate(losses)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "run string, step long, loss double").repartition(6)
    got = telemetry.smoothed_loss(df, beta=beta, width=width).collect()
    for run, losses in runs.items():
        expected = loop(losses, beta)
        mine = [r for r in sorted(got, key=lambda r: r.step) if r.run == run]
        assert len(mine) == len(expected)
        for row, value in zip(mine, expected):
            assert row.failed == (value is None)
            assert row.smoothed == (None if value is None else pytest.approx(value, rel=1e-9))


def test_smoothed_mfu_equals_the_loop(spark):
    values = [random.Random(i).random() for i in range(700)]
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(values)], "run string, step long, mfu double")
    got = {r.step: r.running_mfu for r in telemetry.smoothed_mfu(df, width=128).collect()}
    running = -1.0
    for step, value in enumerate(values):
        if step >= 5:
            running = value if running == -1.0 else 0.9 * running + 0.1 * value
        assert got[step] == pytest.approx(running)


def test_best_checkpoint(spark):
    losses = [3.0, 2.0, 2.5, 2.0, 1.0]
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(losses)], "run string, step long, val_loss double")
    every = telemetry.best_checkpoint(df, width=2).orderBy("step").collect()
    assert [r.best_val_loss for r in every] == [3.0, 2.0, 2.0, 2.0, 1.0]
    assert [r.saved for r in every] == [False, True, True, True, True]
    better = telemetry.best_checkpoint(df, always_save=False, width=2).orderBy("step").collect()
    assert [r.saved for r in better] == [False, True, False, False, True]


def test_nan_is_no_best_loss(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [("r", i, v) for i, v in enumerate([nan, 3.0, nan, 2.0, None, 2.5])], "run string, step long, val_loss double")
    rows = telemetry.best_checkpoint(df, always_save=False, width=2).orderBy("step").collect()
    assert [r.best_val_loss for r in rows] == [None, 3.0, 3.0, 2.0, 2.0, 2.0]
    assert [r.improved for r in rows] == [False, True, False, True, False, False]
    assert [r.saved for r in rows] == [False, True, False, True, False, False]


@pytest.mark.parametrize("beta,width", [(0.9, 8), (0.999, 4)])
def test_an_early_giant_is_not_forgotten(spark, beta, width):
    values = [1e30] + [1e-3] * 900
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(values)], "run string, step long, mfu double")
    got = {r.step: r.running_mfu for r in telemetry.smoothed_mfu(df, beta=beta, warmup=0, width=width).collect()}
    running = None
    for step, value in enumerate(values):
        running = value if running is None else beta * running + (1 - beta) * value
        assert got[step] == pytest.approx(running, rel=1e-9)


def test_throughput_leaves_out_the_first_steps(spark):
    rows = [("r", i, 100.0 if i <= 10 else 0.5) for i in range(21)] + [("short", 0, 1.0)]
    df = spark.createDataFrame(rows, "run string, step long, seconds double")
    got = {r.run: r for r in telemetry.throughput(df, 1000).collect()}
    assert got["r"].timed_steps == 10 and got["r"].tokens_per_second == 2000.0
    assert got["short"].tokens_per_second is None


def test_run_comparison(spark):
    df = spark.createDataFrame([("a", "train", 0.5), ("a", "val", 1.5), ("b", "train", 1.0)],
                               "run string, split string, loss double")
    got = {r.run: r for r in telemetry.run_comparison(df).collect()}
    assert got["a"].gap == 1.0 and got["a"].val_perplexity == pytest.approx(math.exp(1.5))
    assert got["b"].val_loss is None and got["b"].gap is None


def test_number_steps(spark):
    df = spark.createDataFrame([("a", 30), ("a", 10), ("b", 5), ("a", 20)], "run string, ts long").repartition(3)
    got = {(r.run, r.ts): r.step for r in telemetry.number_steps(df, ["ts"]).collect()}
    assert got == {("a", 10): 0, ("a", 20): 1, ("a", 30): 2, ("b", 5): 0}
