from .catalog import BM, BM_XML, CEP_XML, SCAN, SPECS
from .spec import FlattenSpec, Group, load_spec

__all__ = ["BM", "BM_XML", "CEP_XML", "SCAN", "SPECS", "FlattenSpec", "Group", "load_spec"]
