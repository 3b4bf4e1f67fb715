"""Streams by period lose no message, however few files a limited batch may take."""

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare, connect  # noqa: E402

from pairloom.catalog import ORACLES, QUERIES  # noqa: E402
from pairloom.streaming import predictions  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["i1_prediction_ingest", "i2_position_ledger"])
def test_rows_do_not_depend_on_the_number_of_files(spark, monkeypatch, name):
    plain, dealt = predictions.message_stream, set()

    def tight(session, path, files_per_batch=4):
        """The new files of ``path`` dealt into five, the latest messages first, and a limit, if any, of one file."""
        folder = path.removeprefix("file:")
        files = [f for f in sorted(os.listdir(folder)) if f.endswith(".json") and f not in dealt]
        lines = [line for f in files for line in open(f"{folder}/{f}").read().splitlines()]
        lines.sort(key=lambda line: json.loads(line)["sent_at"], reverse=True)
        os.makedirs(f"{folder}-dealt", exist_ok=True)
        for k in range(5):
            out = f"{folder}-dealt/{len(dealt)}-{k}.json"
            part = lines[k * len(lines) // 5:(k + 1) * len(lines) // 5]
            if part:
                open(out, "w").write("".join(f"{line}\n" for line in part))
                os.utime(out, (1.7e9 + 100 * len(dealt) + 10 * k,) * 2)
        dealt.update(files)
        return plain(session, f"{path}-dealt", files_per_batch and 1)
    monkeypatch.setattr(predictions, "message_stream", tight)
    ok, _, _, _, note = compare(spark, connect(DATA), name, QUERIES[name], ORACLES[name], DATA)
    assert ok, note
