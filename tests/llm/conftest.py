import os
from pathlib import Path

# Python workers import the package from here.
os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
