"""Values that tasks need arrive with their code: workers need not have the library on their path."""

import subprocess
import sys


from starmill.llm.tables import Carried

PROGRAM = """
import pickle, sys
from pyspark import cloudpickle
packed = sys.stdin.buffer.read()
assert "starmill" not in sys.modules
found = cloudpickle.loads(packed)
try:
    import starmill
except ImportError:
    pass
else:
    raise SystemExit("the library is on the path here")
print(type(found).__name__, found.languages)
"""


def test_a_carried_model_is_put_together_without_the_library(spark, tmp_path):
    from starmill.llm.language import LanguageModel

    model = LanguageModel({1: {"en": {"a": 3}, "de": {"b": 2}}, 2: {"en": {"ab": 1}}})
    carried = Carried(spark, model)
    assert carried.value.languages == model.languages
    ran = subprocess.run([sys.executable, "-c", PROGRAM], input=carried._packed.value, cwd=tmp_path, env={"PATH": "/usr/bin"},
                         capture_output=True, timeout=120)
    assert ran.returncode == 0, ran.stderr.decode()[-800:]
    assert ran.stdout.decode().startswith("LanguageModel")
