"""State as small numbered files, changed without losing anybody's work.

State n + 1 is created by who has read state n, and only if nobody else was first: then the
change starts again from the newer state. Data files are written under fresh names before the
state that names them, so a change that fails or dies leaves the old state as it is.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tallymark.sources import files

#: Times a change starts again because another one came first.
ATTEMPTS = 50


@dataclass(frozen=True)
class States:
    """The states under `root`. `named` lists the files of a state, relative to root; of the
    newest `keep` states they stay for readers that hold one of them."""

    spark: SparkSession
    root: str
    empty: dict
    files_of: Callable[[dict], Iterable[str]]
    keep: int = 3

    def numbers(self) -> list[int]:
        names = files.list_names(self.spark, f"{self.root}/states")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def path(self, number: int) -> str:
        return f"{self.root}/states/{number:012d}.json"

    def _read(self, number: int) -> dict | None:
        text = files.read_file(self.spark, self.path(number))
        return None if text is None else json.loads(text)

    def live(self) -> tuple[int, dict]:
        """The number of the live state and the state."""
        for number in reversed(self.numbers()):
            state = self._read(number)
            if state is not None:  # else a change has removed it meanwhile
                return number, state
        return 0, json.loads(json.dumps(self.empty))

    def change(self, build: Callable[[dict], tuple[dict, object]], keep_drafts: bool = False):
        """Build the next state from the live one until nobody comes in between. Files that a
        build wrote in vain are removed, unless they are the same at each attempt."""
        for _ in range(ATTEMPTS):
            number, state = self.live()
            after, result = build(state)
            if files.create_file(self.spark, self.path(number + 1), json.dumps(after)):
                self.drop_old()
                return result
            if not keep_drafts:
                self._drop(set(self.files_of(after)) - set(self.files_of(state)))
        raise RuntimeError(f"{self.root}: gave up after {ATTEMPTS} changes by others")

    def named(self) -> set[str]:
        """Files that the kept states name."""
        states = [self._read(number) for number in self.numbers()[-self.keep :]]
        return {file for state in states if state is not None for file in self.files_of(state)}

    def _drop(self, names: Iterable[str]) -> None:
        for name in names:
            files.delete_path(self.spark, f"{self.root}/{name}")

    def drop_old(self) -> None:
        """Remove states beyond the newest, and the files that only they name."""
        old = self.numbers()[: -self.keep]
        if not old:
            return
        kept = self.named()
        for number in old:
            state = self._read(number)
            if state is not None:
                self._drop(set(self.files_of(state)) - kept)
                files.delete_path(self.spark, self.path(number))
