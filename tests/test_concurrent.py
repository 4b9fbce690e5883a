import pytest

from hourcast.plans.concurrent import run_all


def test_run_all_results_in_order_and_first_error_raised(spark):
    assert run_all(lambda: spark.range(5).count(), lambda: spark.range(7).count()) == [5, 7]
    done = []

    def ok():
        done.append(spark.range(3).count())

    def boom():
        raise RuntimeError("job failed")

    with pytest.raises(RuntimeError, match="job failed"):
        run_all(boom, ok)
    assert done == [3]          # the other job still ran to completion
