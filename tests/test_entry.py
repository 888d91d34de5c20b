import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_works_without_the_text_package():
    code = (
        "import sys\n"
        "class Block:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('tidemark.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Block())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert 'detections_top_k' in names and not any(n.startswith('op') for n in names) and 'pipeline' not in names\n"
        "assert not any(m.startswith('tidemark.llm') for m in sys.modules)\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
