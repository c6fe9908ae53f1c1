"""The person record and the fragment schemas."""

from __future__ import annotations

#: Data fields of a person, in order; all are strings but salary.
FIELDS = "passport full_name name lastname sex phone email city address company company_address company_phone company_email job iban salary ipv4".split()

#: A fragment type's keys, and the person field that each fills.
FRAGMENTS = {
    "personal": {"name": "name", "lastname": "lastname", "sex": "sex", "telfnumber": "phone", "passport": "passport", "email": "email"},
    "location": {"fullname": "full_name", "city": "city", "address": "address"},
    "professional": {"fullname": "full_name", "company": "company", "companyaddress": "company_address", "companytelfnumber": "company_phone", "companyemail": "company_email", "job": "job"},
    "bank": {"passport": "passport", "iban": "iban", "salary": "salary"},
    "net": {"address": "address", "ipv4": "ipv4"},
}
UNKNOWN = "unknown"

#: Fields that make a record complete, and those that a curated one must have.
COMPLETENESS_FIELDS = "passport full_name city company iban email phone ipv4".split()
REQUIRED_FIELDS = "full_name passport email city company".split()
LEAST_FILLED = 7


def field_type(field: str) -> str:
    return "double" if field == "salary" else "string"
