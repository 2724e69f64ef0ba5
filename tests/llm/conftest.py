import sys
from pathlib import Path

here = str(Path(__file__).resolve().parent)
if here not in sys.path:
    sys.path.insert(0, here)
