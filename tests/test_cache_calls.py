"""SS2's state processor by itself: which calls to the store an answer costs, and when a key leaves."""

from types import SimpleNamespace

from pyspark.sql import Row

from pennant.streaming.cache import RequestCache


class Store:
    """A value state and its timers; every call is noted."""

    def __init__(self):
        self.value, self.calls, self.timers = None, [], []

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.calls.append("timer")
        self.timers.append(at)


def test_an_answer_costs_two_calls_and_a_key_has_one_timer():
    store, cache = Store(), RequestCache(1_000_000)
    cache.init(store)
    rows = lambda *at: iter([Row(at=t, event_id=i) for i, t in enumerate(at)])
    key, at_ms = ("k", 1, "view"), lambda t: SimpleNamespace(getCurrentWatermarkInMs=lambda: t)
    assert [r.at for r in cache.handleInputRows(key, rows(500, 0, 1_000_000), at_ms(0))] == [0, 1_000_000]
    assert store.timers == [2000] and store.value == (1_000_000,)
    store.calls.clear()
    assert [r.at for r in cache.handleInputRows(key, rows(2_500_000), at_ms(0))] == [2_500_000]
    assert store.calls == ["get", "update"]
    store.timers.clear()
    list(cache.handleExpiredTimer(key, at_ms(2100), None))                       # answered again since: the timer moves on
    assert store.value == (2_500_000,) and store.timers == [3500]
    list(cache.handleExpiredTimer(key, at_ms(3500), None))
    assert store.value is None
