"""Schemas of the graph and of the evidence tables it is built from."""

from __future__ import annotations

PAIRS = "array<struct<key:string,value:string>>"
PACKAGE = f"struct<type:string,namespace:string,name:string,version:string,qualifiers:{PAIRS},subpath:string>"
SOURCE = "struct<type:string,namespace:string,name:string,tag:string,commit:string>"
ARTIFACT = "struct<algorithm:string,digest:string>"
VULNERABILITY = "struct<type:string,vulnerabilityID:string>"
BUILDER = "struct<uri:string>"
LICENSE = "struct<name:string,inline:string,listVersion:string>"

VALUE = "struct<kind:string,s:string,i:bigint,f:double,b:boolean>"
PROPS = f"array<struct<key:string,value:{VALUE}>>"
NODE = f"id string, labels array<string>, props {PROPS}, valid_from timestamp, ord bigint"
EDGE = f"id string, label string, src string, dst string, props {PROPS}, valid_from timestamp, ord bigint"

#: Columns that evidence tables may have besides those of their kind.
COMMON = {"item": "bigint", "doc": "string", "origin": "string", "collector": "string", "documentRef": "string", "justification": "string"}
ENDPOINTS = {"pkg": PACKAGE, "dep_pkg": PACKAGE, "src": SOURCE, "artifact": ARTIFACT, "vulnerability": VULNERABILITY, "builder": BUILDER, "equal_pkg": PACKAGE, "equal_artifact": ARTIFACT, "equal_vulnerability": VULNERABILITY, "materials": f"array<{ARTIFACT}>", "declared": f"array<{LICENSE}>", "discovered": f"array<{LICENSE}>", "match": "string"}
