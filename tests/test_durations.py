import pytest

from streamwin.functions import bound_minutes, interval_micros


@pytest.mark.parametrize(
    "text, minutes",
    [
        ("5 minutes", 5),
        ("1 minute", 1),
        ("7 min", 7),
        ("7 MINS", 7),
        ("30 seconds", 1),
        ("59 sec", 1),
        ("150 secs", 2),
        ("2 hours", 120),
        ("1 hour", 60),
        ("3 fortnights", 3),
        ("5", 5),
        ("", 5),
        ("one minute", 5),
        ("-1 minutes", 5),
        ("1.5 hours", 5),
        ("1 hour 30 minutes", 5),
    ],
)
def test_bound_minutes(text, minutes):
    assert bound_minutes(text, unit_compat=True) == minutes


@pytest.mark.parametrize("text, minutes", [("2 days", 2880), ("1 hour 30 minutes", 90), ("30 seconds", 1), ("7 mins", 7)])
def test_bounds_are_exact(text, minutes):
    assert bound_minutes(text) == minutes


@pytest.mark.parametrize("text", ["5", "", "3 fortnights", "1.5 hours", "-1 minutes"])
def test_bounds_that_are_no_interval(text):
    with pytest.raises(ValueError):
        bound_minutes(text)


@pytest.mark.parametrize(
    "text, seconds",
    [("5 minutes", 300), ("1 hour 30 minutes", 5400), ("interval 1 day", 86400), ("250 milliseconds", 0.25), ("1 week", 604800)],
)
def test_interval_micros(text, seconds):
    assert interval_micros(text) == seconds * 1_000_000


@pytest.mark.parametrize("text", ["", "5", "1 month", "0 seconds", "five minutes", "5 minutes ago"])
def test_interval_micros_rejects(text):
    with pytest.raises(ValueError):
        interval_micros(text)
