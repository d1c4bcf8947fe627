"""The fixtures' helper under a name that tests can import."""

import importlib.util
import os

_spec = importlib.util.spec_from_file_location("llm_conftest", os.path.join(os.path.dirname(__file__), "conftest.py"))
_module = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_module)
frame, make_texts = _module.frame, _module.make_texts
