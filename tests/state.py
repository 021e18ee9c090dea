"""State of a processor, kept in memory, that counts its writes."""

from __future__ import annotations


class Map:
    def __init__(self):
        self.held, self.writes = {}, 0

    def updateValue(self, key, value):
        self.held[key] = value
        self.writes += 1

    def removeKey(self, key):
        del self.held[key]
        self.writes += 1

    def iterator(self):
        return iter(list(self.held.items()))

    def clear(self):
        self.held = {}


class Value:
    held = None
    exists = lambda self: self.held is not None
    get = lambda self: self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Handle:
    def __init__(self):
        self.timers = []

    getMapState = lambda self, *_: Map()
    getValueState = lambda self, *_: Value()
    listTimers = lambda self: iter(self.timers)

    def registerTimer(self, at):
        self.timers = [*self.timers, at]

    def deleteTimer(self, at):
        self.timers = [t for t in self.timers if t != at]


class Now:
    def __init__(self, now):
        self.getCurrentWatermarkInMs = self.getCurrentProcessingTimeInMs = lambda: int(now * 1000)
