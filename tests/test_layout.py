"""The training-data folder can be taken out: nothing else may import it."""

from __future__ import annotations

import re
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_else_imports_the_training_data_operators():
    files = [f for f in (ROOT / "trendlake").rglob("*.py") if "llm" not in f.relative_to(ROOT).parts]
    files += [ROOT / "bench.py", ROOT / "compare.py", *(ROOT / "tests").glob("*.py")]
    found = [f for f in files if re.search(r"^\s*(from|import) (trendlake\.llm|corpus_pipeline)", f.read_text(), re.M)]
    assert len(files) > 30 and found == []
