"""What streams remember of a key, as machines that rows are given to in the order of time.

A machine is made from its state, a list that JSON can hold, or from None. ``step`` takes a row, whose first field is its time
in microseconds, ``until`` is told that no row up to a time is to come any more, ``wait`` says behind which time it has something
to tell without a further row (None: never). Both give rows of output. ``state`` None: there is nothing to remember.
"""

from __future__ import annotations


class Outages:
    """(restart_us, healthy_us, next_us) at each restart behind a healthy line; row: us, position, restart, healthy."""

    def __init__(self, state: list | None = None, min_downtime: float = 0.0):
        self.start, self.last = state or (-1, -1)
        self.least = min_downtime * 1e6

    @property
    def state(self) -> list:
        return [self.start, self.last]

    def step(self, us: int, _position: int, restart: bool, healthy: bool) -> list[tuple]:
        out = []
        if restart:
            if self.start >= 0 and self.last >= 0 and us - self.last >= self.least:
                out.append((self.start, self.last, us))
            self.start, self.last = us, -1
        elif healthy and self.start >= 0:
            self.last = us
        return out

    def wait(self) -> None:
        return None

    def until(self, _us: int) -> list[tuple]:
        return []


class Motion:
    """(start, end, reason) of a camera's clips; row: us, frame, moves; rules are those of runs.MotionMachine."""

    def __init__(self, state: list | None = None, fps: float = 10.0, **rules: float):
        from tidewell.operators.runs import MotionMachine

        self.machine = MotionMachine(fps, state=tuple(state) if state else None, **rules)

    @property
    def state(self) -> list:
        return list(self.machine.state)

    def step(self, _us: int, frame: int, moves: bool) -> list[tuple]:
        found = self.machine.step(frame, moves)
        return [found] if found else []

    def wait(self) -> None:
        return None

    def until(self, _us: int) -> list[tuple]:
        return []


class Parts:
    """(opened_us, part, start_us, end_us, n_cameras): parts of a site's events; row: us, camera, of frames that move."""

    def __init__(self, state: list | None = None, gap: int = 5_000_000, length: int = 120_000_000):
        self.gap, self.length = gap, length
        self.opened, self.part, self.first, self.last, seen = state or (-1, 0, -1, -1, [])
        self.seen = set(seen)

    @property
    def state(self) -> list | None:
        return [self.opened, self.part, self.first, self.last, sorted(self.seen)] if self.opened >= 0 else None

    def _give(self) -> tuple:
        return self.opened, self.part, self.first, self.last, len(self.seen)

    def step(self, us: int, camera: str) -> list[tuple]:
        out = []
        if self.opened < 0 or us - self.last > self.gap:
            out = [self._give()] if self.opened >= 0 else []
            self.opened, self.part, self.first, self.seen = us, 0, us, set()
        elif (us - self.opened) // self.length > self.part:
            out = [self._give()]
            self.part, self.first, self.seen = (us - self.opened) // self.length, us, set()
        self.last = us
        self.seen.add(camera)
        return out

    def wait(self) -> int | None:
        return self.last + self.gap if self.opened >= 0 else None

    def until(self, us: int) -> list[tuple]:
        if self.opened < 0 or us <= self.last + self.gap:
            return []
        out = [self._give()]
        self.opened = -1
        return out


class Coordinator:
    """(opened_us, part, camera, start_us, end_us, reason, originator): clips of a site's cameras, which share their events.

    row: us, camera, moves, of all frames. A camera that has moved for ``need`` frames in a row opens an event, and at their
    next frames the others join it. A camera's clip ends

    * "final": when no camera has moved for the gap. The first frame to find that ends its own camera's clip; the event now
      drains: the others end theirs at their next frames, and nobody may join. When all have left, it is closed.
    * "part": when the part is as long as ``length``. The frame that finds it begins the next part for all; each camera
      ends its clip at its next frame, and goes on at the one behind. An end beats a new part, also one that is due already.
    * "silent": at its last frame, when a camera has sent none for the gap.

    A camera that asks to join or to open while an event drains is refused (a row of reason "refused", with its time, once a
    drain) and asks again at its next frames.
    """

    def __init__(self, state: dict | None = None, gap: int = 5_000_000, length: int = 120_000_000, need: int = 2):
        self.gap, self.length, self.need = gap, length, need
        # event: opened, part, part_start, moved, originator, drains; cameras: phase, part, start, last, run, due, asked
        self.event, self.cameras = (state["event"], state["cameras"]) if state else (None, {})

    @property
    def state(self) -> dict | None:
        busy = self.event or any(c["run"] for c in self.cameras.values())
        return {"event": self.event, "cameras": self.cameras} if busy else None

    def _clip(self, name: str, end: int, reason: str) -> tuple:
        c, e = self.cameras[name], self.event
        return e["opened"], c["part"], name, c["start"], end, reason, e["originator"]

    def _leave(self, name: str) -> None:
        self.cameras[name] |= {"phase": "left", "run": 0, "due": ""}
        if all(c["phase"] in ("idle", "left") for c in self.cameras.values()):
            self.event = None
            for c in self.cameras.values():
                c |= {"phase": "idle", "due": "", "asked": False}

    def _recording(self) -> list[str]:
        return [n for n, c in self.cameras.items() if c["phase"] in ("open", "next")]

    def step(self, us: int, name: str, moves: bool) -> list[tuple]:
        out = self.until(us)
        c = self.cameras.setdefault(name, {"phase": "idle", "part": 0, "start": 0, "last": us, "run": 0, "due": "", "asked": False})
        c["last"], e = us, self.event
        if c["phase"] == "next":
            if c["due"] == "final":  # the event ended before the next part began
                self._leave(name)
            else:
                c |= {"phase": "open", "part": e["part"], "start": us}
        elif c["phase"] == "open":
            if moves and not c["due"]:
                e["moved"] = us
            if not c["due"] and us - e["moved"] >= self.gap:
                e["drains"] = True
                for n in self._recording():
                    self.cameras[n]["due"] = "final"
            elif not c["due"] and us - e["part_start"] >= self.length:
                e |= {"part": e["part"] + 1, "part_start": us}
                for n in self._recording():
                    self.cameras[n]["due"] = self.cameras[n]["due"] or "part"
            if c["due"]:
                out.append(self._clip(name, us, c["due"]))
                if c["due"] == "final":
                    self._leave(name)
                else:
                    c |= {"phase": "next", "due": ""}
        else:
            c["run"] = c["run"] + 1 if moves else 0
            called = e is not None and c["phase"] == "idle"  # others open, and this one has not been part of the event yet
            if called or c["run"] >= self.need:
                if e is None:
                    self.event = e = {"opened": us, "part": 0, "part_start": us, "moved": us, "originator": name, "drains": False}
                if e["drains"]:
                    if not c["asked"]:
                        out.append((e["opened"], e["part"], name, us, us, "refused", e["originator"]))
                        c["asked"] = True
                else:
                    c |= {"phase": "open", "part": e["part"], "start": us, "run": 0, "due": ""}
        return out

    def wait(self) -> int | None:
        return min((self.cameras[n]["last"] for n in self._recording()), default=-self.gap - 1) + self.gap if self._recording() else None

    def until(self, us: int) -> list[tuple]:
        out = []
        for n in sorted(self._recording()):
            c = self.cameras[n]
            if us > c["last"] + self.gap:
                if c["phase"] == "open":
                    out.append(self._clip(n, c["last"], "silent"))
                self._leave(n)
        for n in [n for n, c in self.cameras.items() if us > c["last"] + self.gap and c["phase"] == "idle"]:
            del self.cameras[n]  # forgotten
        return out


class Track:
    """(start_us, n, first_x, last_x, cls, direction) of a track's appearances; row: us, position, x, cls."""

    def __init__(self, state: list | None = None, line: float = 0.5, expiry: int = 1_000_000):
        self.line, self.expiry = line, expiry
        self.first, self.first_x, self.last, self.last_x, self.n, self.votes = state or (-1, 0.0, -1, 0.0, 0, {})

    @property
    def state(self) -> list | None:
        return [self.first, self.first_x, self.last, self.last_x, self.n, self.votes] if self.n else None

    def _give(self) -> tuple:
        best = min(self.votes, key=lambda c: (-self.votes[c][0], self.votes[c][1]))
        way = "r" if self.first_x < self.line <= self.last_x else "l" if self.first_x > self.line >= self.last_x else None
        return self.first, self.n, self.first_x, self.last_x, best, way

    def step(self, us: int, _position: int, x: float, cls: str) -> list[tuple]:
        out = self.until(us)
        if not self.n:
            self.first, self.first_x, self.votes = us, x, {}
        have = self.votes.setdefault(cls, [0, us])
        have[0] += 1
        self.last, self.last_x, self.n = us, x, self.n + 1
        return out

    def wait(self) -> int | None:
        return self.last + self.expiry if self.n else None

    def until(self, us: int) -> list[tuple]:
        if not self.n or us <= self.last + self.expiry:
            return []
        out = [self._give()]
        self.n = 0
        return out


class Output:
    """(kind, since_us): "stalled" and "absent" outputs; row: us, size. A state of [-1, since, -1, False, False] is of an output
    that is expected from then on, but has not reported."""

    def __init__(self, state: list | None = None, limit: int = 60_000_000):
        self.limit = limit
        self.grown, self.last, self.most, self.told, self.gone = state or (-1, -1, -1, False, False)

    @property
    def state(self) -> list | None:
        return [self.grown, self.last, self.most, self.told, self.gone] if self.last >= 0 else None

    def step(self, us: int, size: int) -> list[tuple]:
        out = self.until(us)
        if size > self.most:
            self.grown, self.most, self.told = us, size, False
        elif not self.told and us - self.grown >= self.limit:
            out.append(("stalled", self.grown))
            self.told = True
        self.last, self.gone = us, False
        return out

    def wait(self) -> int | None:
        return self.last + self.limit if self.last >= 0 and not self.gone else None

    def until(self, us: int) -> list[tuple]:
        if self.last < 0 or self.gone or us <= self.last + self.limit:
            return []
        self.gone = True
        return [("absent", self.last)]
