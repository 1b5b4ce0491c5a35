"""Shape of the 17 ERP tables: stored table name, stored columns, our names and types.

``code`` columns are compared as they are stored, so that their filters reach the file scan;
``padded`` ones are compared without trailing blanks. Other types are Spark type names, and ``None``
keeps the stored type.
"""

from __future__ import annotations

CODE = "code"
PADDED = "padded"
TEXT = "string"
MONEY = "decimal(18,2)"
TIME = "timestamp_ntz"

# Names of the stored tables and columns.
TABLES: dict[str, tuple[str, list[tuple[str, str, str | None]]]] = {
    "party": ("CiaTab", [
        ("OriCod", "origin", CODE), ("CiaCod", "party", PADDED), ("CiaIdeNum", "tax_id", CODE),
        ("CiaDes", "name", TEXT), ("CiaSig", "short_name", TEXT), ("CiaFehCre", "created", TIME),
        ("IdeTipCod", "id_type_code", "int"), ("CiaEst", "status", CODE)]),
    "party_class": ("Cid", [
        ("OriCod", "origin", CODE), ("CiaCod", "party", PADDED), ("IndGrp", "tag_group", CODE),
        ("IndCod", "tag_code", CODE)]),
    "site": ("LocTab", [
        ("OriCod", "origin", CODE), ("CiaCod", "party", PADDED), ("LocCod", "site", CODE),
        ("LocEst", "status", CODE), ("LocDes", "name", TEXT), ("LocDir", "address", TEXT),
        ("PaiCod", "country", CODE), ("DptCod", "state", CODE), ("PvnCod", "province", CODE),
        ("DstCod", "district", CODE)]),
    "document": ("DocCab", [
        ("OriCod", "origin", CODE), ("CiaCod", "party", PADDED), ("LocCod", "site", CODE),
        ("DocTipCod", "type", CODE), ("DocEst", "status", CODE), ("DocMto", "amount", MONEY),
        ("DocSld", "balance", MONEY), ("DocFecCre", "created", TIME), ("DocFecVct", "due", TIME),
        ("DocNum", "number", None)]),
    "quote": ("OcmCab", [
        ("OriCod", "origin", CODE), ("CiaCod", "party", PADDED), ("OcmFehCre", "created", TIME),
        ("OcmEst", "status", "int")]),
    "origin": ("OriTab", [("OriCod", "origin", CODE), ("PaiCod", "country", CODE)]),
    "id_type": ("IdeTip", [
        ("OriCod", "origin", CODE), ("IdeTipCod", "id_type_code", "int"),
        ("IdeTipDes", "name", TEXT)]),
    "party_param": ("CiaPar", [
        ("CiaCod", "party", PADDED), ("OriCod", "origin", CODE), ("ParCod", "code", CODE),
        ("CiaParVal", "value", TEXT)]),
    "country": ("PaiTab", [("PaiCod", "country", CODE), ("PaiDes", "name", TEXT)]),
    "state": ("DptTab", [
        ("OriCod", "origin", CODE), ("PaiCod", "country", CODE), ("DptCod", "state", CODE),
        ("DptDes", "name", TEXT), ("DptEst", "status", CODE)]),
    "province": ("PvnTab", [
        ("OriCod", "origin", CODE), ("PaiCod", "country", CODE), ("DptCod", "state", CODE),
        ("PvnCod", "province", CODE), ("PvnDes", "name", TEXT)]),
    "district": ("DstTab", [
        ("OriCod", "origin", CODE), ("PaiCod", "country", CODE), ("DptCod", "state", CODE),
        ("PvnCod", "province", CODE), ("DstCod", "district", CODE), ("DstDes", "name", TEXT),
        ("DstPstCod", "postal_code", TEXT)]),
    "contact_point": ("TelTab", [
        ("OriCod", "origin", CODE), ("CiaCod", "party", PADDED), ("LocCod", "site", CODE),
        ("TelCod", "code", None), ("TelTipCod", "type", "int"), ("TelEst", "status", CODE),
        ("TelNum", "number", TEXT)]),
    "contact_person": ("CttTab", [
        ("CiaCod", "party", PADDED), ("LocCod", "site", CODE), ("CrgDes", "role", PADDED),
        ("CttNom", "first_name", TEXT), ("CttApePat", "last_name", TEXT)]),
    "account": ("CiaCtaTab", [
        ("OriCod", "origin", CODE), ("CiaCod", "party", PADDED), ("CiaCtaNum", "number", TEXT),
        ("CiaCtaTip", "type", TEXT), ("CiaCtaEst", "status", TEXT)]),
    "site_tag": ("LID", [
        ("OriCod", "origin", CODE), ("CiaCod", "party", PADDED), ("LocCod", "site", CODE),
        ("IndGrp", "tag_group", CODE), ("IndCod", "tag_code", CODE)]),
    "tag_type": ("IndTip", [
        ("OriCod", "origin", CODE), ("IndGrp", "tag_group", CODE), ("IndCod", "tag_code", CODE),
        ("IndDes", "name", TEXT)]),
}

RECORD = ["origin", "party"]
SITE = ["origin", "party", "site"]
