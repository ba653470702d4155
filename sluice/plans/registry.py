"""How a family of queries collects itself."""

from __future__ import annotations


class Family:
    def __init__(self):
        self.queries: dict = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        def keep(f):
            self.queries[name] = f
            if sql:
                self.oracles[name] = sql
            return f

        return keep
