"""A client for ``export_once``: a folder stands in for a database with a staging table."""

from __future__ import annotations

import json
import os


class StagingClient:
    """``staged/<token>`` holds the rows of a task's attempt; publishing moves them to ``published/<export>``."""

    def __init__(self, folder: str, fail_once: bool = False, fail_always: bool = False):
        self.folder, self.fail_once, self.fail_always = folder, fail_once, fail_always
        for name in ("staged", "published", "failed"):
            os.makedirs(f"{folder}/{name}", exist_ok=True)
        self.batches = 0

    def stage(self, token: str, rows) -> None:
        with open(f"{self.folder}/staged/{token}", "a") as f:
            f.writelines(json.dumps(list(r), default=str) + "\n" for r in rows)
        self.batches += 1
        if self.batches == 2 and (self.fail_always or self.fail_once and self._first()):
            raise ConnectionError("lost in the middle of a task")

    def _first(self) -> bool:
        try:
            os.close(os.open(f"{self.folder}/failed/once", os.O_CREAT | os.O_EXCL))
            return True
        except FileExistsError:
            return False

    def publish(self, export_id: str, tokens) -> None:
        target = f"{self.folder}/published/{export_id}"
        if not os.path.exists(target):
            rows = [line for t in tokens for line in open(f"{self.folder}/staged/{t}")]
            with open(f"{target}.new", "w") as f:
                f.writelines(rows)
            os.replace(f"{target}.new", target)
        self.discard(tokens)

    def discard(self, tokens) -> None:
        for t in tokens:
            if os.path.exists(f"{self.folder}/staged/{t}"):
                os.remove(f"{self.folder}/staged/{t}")

    def close(self) -> None:
        pass

    @staticmethod
    def published(folder: str) -> list:
        return [json.loads(line)[0] for n in os.listdir(f"{folder}/published") for line in open(f"{folder}/published/{n}")]

    @staticmethod
    def waiting(folder: str) -> list:
        return os.listdir(f"{folder}/staged")

    @staticmethod
    def failures(folder: str) -> int:
        return len(os.listdir(f"{folder}/failed"))
