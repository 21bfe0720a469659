"""A remote store for tests: a local folder, listed by pages of three; names tell what fails, and how often."""

import os
from pathlib import Path

TRIES: dict = {}


class Store:
    def __init__(self):
        self.root = Path(os.environ["FAKE_STORE"])
        self.names = [n for n in (self.root / "listing").read_text().split("\n") if n]

    def pages(self):
        return list(range(0, len(self.names), 3))

    def page(self, token):
        if self.names[token].startswith("lost"):
            raise OSError("page is gone")
        return self.names[token : token + 3]

    def fetch(self, name):
        TRIES[name] = TRIES.get(name, 0) + 1
        if "broken" in name or "flaky" in name and TRIES[name] < 3:
            raise OSError(f"cannot read {name}")
        return name.encode() * 3


def make():
    return Store()
