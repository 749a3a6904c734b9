"""The entry points without libraries that only the corpus operators need."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_core_queries_do_without_corpus_libraries():
    code = "import sys\nfor m in ('xxhash', 'regex', 'public_tokenizers'): sys.modules[m] = None\nimport __spark_entry__ as e\nprint(len(e.queries()), any(q.startswith('op') for q in e.queries()))"
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    n, corpus = out.stdout.split()
    assert int(n) > 90 and corpus == "False"
