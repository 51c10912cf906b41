"""The entry points work without the training-text package."""

import subprocess
import sys

HIDDEN = """
import sys
sys.path.insert(0, {root!r})
sys.modules['shelfline.llm'] = None
import __spark_entry__ as entry
names = set(entry.queries())
assert 'pipeline' not in names and not any(n.startswith('op10_') for n in names)
assert len(names) > 150 and set(entry.oracle_sql()) <= names
"""


def test_entry_without_the_text_package():
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", HIDDEN.format(root=root)], check=True)
