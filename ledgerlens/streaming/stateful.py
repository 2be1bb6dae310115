"""Processors with state of their own: one decision for a request, and bounded memories of used ids."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ASKED, ANSWERED = "asked", "answered"


class Decisions(StatefulProcessor):
    """One decision for each request: its first valid answer, or ``expired``.

    The key is a bucket of requests: its open requests and answers are one list of state that is read and written once a batch,
    so a request costs no calls of its own to the state store. Rows have ``bucket, request_id, user_id, nonce``, ``what`` (asked or answered), ``ts_ms``
    and ``approved``. An answer counts from the request's time on, for ``window_ms``. It decides once the watermark has passed it, as no earlier one can come then; a
    rejection goes before an approval of the same time. Answers that come before their request are kept until the watermark
    passes them.
    """

    OUTPUT = "request_id long, decision string, decided_ms long"
    #: an open request (rejected null) or an answer
    OPEN = "request_id long, user_id {user_id}, nonce {nonce}, ts_ms long, rejected boolean"

    def __init__(self, window_ms: int, user_id: str = "string", nonce: str = "string"):
        self.window_ms, self.held = window_ms, self.OPEN.format(user_id=user_id, nonce=nonce)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", self.held)

    def _read(self) -> tuple[dict, dict]:
        asked, answers = {}, {}
        for *key, ts_ms, rejected in self.open.get() if self.open.exists() else ():
            if rejected is None:
                asked[tuple(key)] = ts_ms
            else:
                answers.setdefault(tuple(key), []).append((ts_ms, rejected))
        return asked, answers

    def _write(self, asked: dict, answers: dict) -> None:
        """Keeps what is open, and one timer for the moment at which the next of it is due."""
        rows = [(*key, ts_ms, None) for key, ts_ms in asked.items()] + [(*key, *a) for key, given in answers.items() for a in given]
        if not rows:
            self.open.clear()
            return
        self.open.put(rows)
        due = [ts_ms + self.window_ms for ts_ms in asked.values()] + [ts_ms for given in answers.values() for ts_ms, _ in given]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(min(due) + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        asked, answers = self._read()
        for _, request_id, user_id, nonce, what, ts_ms, approved in (row[:7] for row in rows):
            own = request_id, user_id, nonce
            if what == ASKED:
                asked[own] = min(ts_ms, asked.get(own, ts_ms))
            else:
                answers.setdefault(own, []).append((ts_ms, not approved))
        self._write(asked, answers)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # all that lies behind the watermark, as timers of their own would have told one by one
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        asked, answers = self._read()
        done = []
        for own, ts_ms in list(asked.items()):
            first = min((a for a in answers.get(own, ()) if ts_ms <= a[0] <= ts_ms + self.window_ms), default=None)
            if (first and first[0] < now) or ts_ms + self.window_ms < now:
                del asked[own]
                answers.pop(own, None)
                decision = "expired" if first is None else "rejected" if first[1] else "approved"
                done.append(Row(request_id=own[0], decision=decision, decided_ms=first and first[0]))
        left = {own: given if own in asked else [a for a in given if a[0] >= now] for own, given in answers.items()}
        self._write(asked, {own: given for own, given in left.items() if given})
        return iter(done)

    def close(self) -> None:
        pass


class Memory(StatefulProcessor):
    """Whether each id is new to its connection (the key), by a memory with a horizon and a bound.

    Rows have ``id``, ``at_ms`` and ``row_id`` and are taken in the order of (at_ms, row_id). An id is remembered for ``horizon_ms`` from its
    first use, and is ``replayed`` until then. A full memory either forgets its oldest id or, with ``refuse``, takes no new
    one (``cache_full``). The ids, at most ``entries``, are one list of state, oldest first, that is read and written once a batch; a use
    makes no call to the state store. An idle connection's memory is cleared by a timer.
    """

    OUTPUT = "row_id long, refusal string"

    def __init__(self, horizon_ms: int, entries: int, refuse: bool):
        self.horizon_ms, self.entries, self.refuse = horizon_ms, entries, refuse

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "id string, at_ms long")

    def _read(self) -> deque:
        return deque(tuple(h) for h in self.held.get()) if self.held.exists() else deque()

    def _write(self, queue: deque) -> None:
        if queue:
            self.held.put(list(queue))
        else:
            self.held.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        queue = self._read()
        seen = {id_ for id_, _ in queue}
        at, out = None, []
        for at, row_id, id_ in sorted(((at_ms, row_id, id_) for _, id_, at_ms, row_id in (row[:4] for row in rows)), key=itemgetter(0, 1)):
            while queue and queue[0][1] + self.horizon_ms < at:
                seen.remove(queue.popleft()[0])
            refusal = None
            if id_ in seen:
                refusal = "replayed"
            elif len(queue) >= self.entries and self.refuse:
                refusal = "cache_full"
            else:
                if len(queue) >= self.entries:
                    seen.remove(queue.popleft()[0])
                seen.add(id_)
                queue.append((id_, at))
            out.append((row_id, refusal))
        self._write(queue)
        self.handle.registerTimer(at + self.horizon_ms + 1)
        return (Row(row_id=row_id, refusal=refusal) for row_id, refusal in out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        queue = self._read()
        if queue and queue[0][1] + self.horizon_ms < expiredTimerInfo.getExpiryTimeInMs():
            while queue and queue[0][1] + self.horizon_ms < expiredTimerInfo.getExpiryTimeInMs():
                queue.popleft()
            self._write(queue)
        return iter(())

    def close(self) -> None:
        pass
