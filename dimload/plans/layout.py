"""Names and types of the warehouse tables the jobs load.

Everything in this module is a fixed value: the jobs read and write tables that
exist elsewhere under exactly these names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from ..operators.scd2 import Scd2Layout

# Table names, and the registry's names for the two targets.


@dataclass(frozen=True)
class Tables:
    organisation: str = "STG_CLIC_CUSTSORGEXT"
    contact: str = "STG_CLIC_CUSTSCONTACT"
    history: str = "STG_CLIC_CUSTSCONTACTHIST"
    address: str = "STG_CLIC_CUSTADDRORG"
    registry: str = "STG_CLIC_SURROGKEYS"
    customer_dim: str = "IM_CUSTOMER_ATTRIBUTE_REF"
    address_dim: str = "IM_CUSTOMER_ADDRESS_SCD"
    customer_registry_name: str = "IM_CUSTOMER_ATTRIBUTE_REF"
    address_registry_name: str = "IM_CUSTOMER_ADDRESS_SCD"


# Codes in the data.
SOURCE_SYSTEM = "CLIC"
PURGE_RECORD = "Removed Block"
MERGE_RECORD = "Merged Account"
SHIPPING = "SHIPADDR0"
BILLING = "BILLADDR1"
MARKETING = "MKTADDR"

# Staged column -> target column.
ACCOUNT = "HSN_ACCT_NUM"
DELETED_ACCOUNT = "DELETED_HSN_ACCT_NUM"

ORGANISATION_COPIES = {
    "PRIMARY_PHONE_NUM": "PRIMARY_PHONE_NUMBER",
    "GUEST_CUSTOMER_FLAG": "GUEST_CODE",
    "GUID": "DIGITAL_CUSTOMER_ID",
    "MARKET_PLACE_ID": "MARKET_PLACE_ID",
    "MARKET_PLACE_CUSTID": "MARKET_PLACE_CUST_ID",
    "PRIMARY_PHONE_TYPE": "PRIMARY_PHONE_TYPE",
    "ALT_PHONE1_NUMBER": "ALT_PHONE1_NUMBER",
    "ALT_PHONE1_TYPE": "ALT_PHONE1_TYPE",
    "ALT_PHONE2_NUMBER": "ALT_PHONE2_NUMBER",
    "ALT_PHONE2_TYPE": "ALT_PHONE2_TYPE",
}
CONTACT_COPIES = {
    "CUSTOMER_SINCE_DATE": "CUSTOMER_SINCE_DT",
    "FIRST_NAME": "FIRST_NAME",
    "LAST_NAME": "LAST_NAME",
    "EMAIL_SOURCE_CODE": "CLIC_EMAIL_SOURCE_CODE",
    "EMAIL_ADDRESS": "CLIC_EMAIL_ADDRESS",
    "LAST_EMAIL_DATE": "CLIC_EMAIL_LAST_UPDT",
    "MEDIA_TYPE": "MEDIA_CODE",
    "HSN_EMP_ID": "EMPLOYEE_ID",
}
CONTACT_FLAGS = {
    "SUPRESS_EMAIL_FLAG": "SUPPRESS_EMAIL_IND",
    "SEND_NEWS_FLAG": "SEND_NEWS_IND",
    "SUPRESS_CALL_FLAG": "SUPPRESS_CALL_IND",
    "SUPRESS_MAIL_FLAG": "SUPPRESS_MAIL_IND",
    "DIRECT_DEBIT_FLAG": "BANK_DIRECT_DEBIT_IND",
    "FLEX_PAY_LIMIT_FLAG": "HAS_FLEXPAY_LIMIT_IND",
    "NAT_TAX_EXEMPT_FLAG": "NATIONAL_TAX_EXEMPT_IND",
    "NO_FLEXPAY_FLAG": "FLEXPAY_IND",
    "NO_ON_AIR_FLAG": "ALLOW_ONAIR_IND",
    "NO_REFUND_FLAG": "ALLOW_REFUND_IND",
    "NO_SHIP_ADDR_FLAG": "SHIP_ADDR_IND",
    "ST_TAX_EXEMPT_FLAG": "STATE_TAX_EXEMPT_IND",
    "AUTOSHIP_CUST_FLAG": "AUTOSHIP_CUSTOMER_IND",
    "ABUSIVE_RETURNS_FLAG": "ABUSIVE_RETURNS_IND",
    "PROMO_FLAG": "DYN_MSG_PROMO_IND",
}
CONTACT_COUNTS = {
    "ABUSIVE_RETURNS_COUNT": "ABUSIVE_RETURNS_CNT",
    "CALL_TAG_COUNT": "CALL_TAG_CNT",
    "EMPTY_BOX_COUNT": "EMPTY_BOX_CNT",
}
# Columns the contact refresh erases although no feed brings them.
CONTACT_ALSO_ERASED = ["DOTCOM_EMAIL_ADDRESS", "DOTCOM_EMAIL_LAST_UPDT"]
ADDRESS_COPIES = {
    "ADDRESS_LINE_1": "ADDR_LINE1_TXT",
    "ADDRESS_LINE_2": "ADDR_LINE2_TXT",
    "CITY": "CITY_NAME",
    "STATE": "STATE_CODE",
    "COUNTRY": "COUNTRY_CODE",
    "ADDRESS_TYPE_CODE": "ADDR_TYPE_CODE",
    "SHIP_TO_FIRST_NAME": "SHIPTO_FIRST_NAME",
    "SHIP_TO_LAST_NAME": "SHIPTO_LAST_NAME",
}
# Staged flag -> (target indicator, the flag value that means 1).
ADDRESS_FLAGS = {
    "DISABLE_CLEANSING_FLAG": ("ADDR_CLEANSING_IND", "N"),
    "FRAUD_BAD_ACCT_FLAG": ("ADDR_FRAUD_IND", "Y"),
    "AGENT_VERIFIED_ADDRESS": ("ADDR_QAS_VERIFIED_IND", "Y"),
}

# What a new customer starts with.
NEW_CUSTOMER_UNKNOWN_KEYS = [
    "PRIMARY_ADDRESS_KEY",
    "BILLING_ADDRESS_KEY",
    "MKTADDR_ADDRESS_KEY",
    "IDCENTRIC_INDIVIDUAL_ID",
    "IDCENTRIC_HOUSEHOLD_ID",
    "IDCENTRIC_ADDRESS_ID",
]
NEW_CUSTOMER_ZEROES = [
    "PURGED_IND",
    "MERGED_IND",
    "TEST_CUSTOMER_IND",
    "BLOCK_CURRENT_IND",
    "BLOCK_LIFETIME_IND",
    "VOID_IND",
    "PRIVACY_IND",
]

# Which address roles fill which customer column, best first.
ADDRESS_ROLES = {
    "PRIMARY_ADDRESS_KEY": [SHIPPING],
    "BILLING_ADDRESS_KEY": [BILLING, SHIPPING],
    "MKTADDR_ADDRESS_KEY": [MARKETING],
}


def _schema(groups: dict[str, str]) -> T.StructType:
    kinds = {"bigint": T.LongType, "int": T.IntegerType, "string": T.StringType, "timestamp": T.TimestampType}
    fields = [T.StructField(name, kinds[kind]()) for name, kind in groups.items()]
    return T.StructType(fields)


# The two target tables.
CUSTOMER_SCHEMA = _schema(
    {
        "CUSTOMER_KEY": "bigint",
        "PRIMARY_ADDRESS_KEY": "bigint",
        "BILLING_ADDRESS_KEY": "bigint",
        "CUSTOMER_ID": "bigint",
        "ETL_SOURCE_SYSTEM": "string",
        "SOURCE_CREATE_DT": "timestamp",
        "CUSTOMER_SINCE_DT": "string",
        "FIRST_NAME": "string",
        "LAST_NAME": "string",
        "CLIC_EMAIL_SOURCE_CODE": "string",
        "CLIC_EMAIL_ADDRESS": "string",
        "CLIC_EMAIL_LAST_UPDT": "string",
        "DOTCOM_EMAIL_ADDRESS": "string",
        "DOTCOM_EMAIL_LAST_UPDT": "string",
        "MEDIA_CODE": "string",
        "EMPLOYEE_ID": "string",
        "SUPPRESS_EMAIL_IND": "int",
        "SEND_NEWS_IND": "int",
        "SUPPRESS_CALL_IND": "int",
        "SUPPRESS_MAIL_IND": "int",
        "BANK_DIRECT_DEBIT_IND": "int",
        "HAS_FLEXPAY_LIMIT_IND": "int",
        "NATIONAL_TAX_EXEMPT_IND": "int",
        "FLEXPAY_IND": "int",
        "ALLOW_ONAIR_IND": "int",
        "ALLOW_REFUND_IND": "int",
        "SHIP_ADDR_IND": "int",
        "STATE_TAX_EXEMPT_IND": "int",
        "AUTOSHIP_CUSTOMER_IND": "int",
        "ABUSIVE_RETURNS_IND": "int",
        "ABUSIVE_RETURNS_CNT": "bigint",
        "CALL_TAG_CNT": "bigint",
        "EMPTY_BOX_CNT": "bigint",
        "PRIMARY_PHONE_NUMBER": "string",
        "DERIVED_AREA_CODE": "bigint",
        "BILLSHIP_ADDR_SYNC_IND": "int",
        "PROVIDIAN_ACCT_NBR": "string",
        "PROVIDIAN_MARKETING_CODE": "string",
        "PROVIDIAN_UPDATE_DT": "timestamp",
        "PURGED_IND": "int",
        "PURGED_DT": "timestamp",
        "MERGED_IND": "int",
        "MERGED_DT": "timestamp",
        "MERGED_SOURCE_ACCT_ID": "bigint",
        "TEST_CUSTOMER_IND": "int",
        "BLOCK_CURRENT_IND": "int",
        "BLOCK_LIFETIME_IND": "int",
        "IDCENTRIC_INDIVIDUAL_ID": "bigint",
        "IDCENTRIC_HOUSEHOLD_ID": "bigint",
        "IDCENTRIC_ADDRESS_ID": "bigint",
        "VOID_IND": "int",
        "INS_BATCH_NBR": "bigint",
        "UPD_BATCH_NBR": "bigint",
        "MKTADDR_ADDRESS_KEY": "bigint",
        "DYN_MSG_PROMO_IND": "int",
        "FST_ORDER_DT": "timestamp",
        "FST_ORDER_SUBSIDIARY_KEY": "bigint",
        "FST_ORDER_ITEM_KEY": "bigint",
        "FST_SHIP_DT": "timestamp",
        "FST_SHIP_SUBSIDIARY_KEY": "bigint",
        "FST_SHIP_ITEM_KEY": "bigint",
        "TV_TO_DOTCOM_DT": "timestamp",
        "DOTCOM_TO_TV_DT": "timestamp",
        "SCND_SHIP_DT": "timestamp",
        "SCND_SHIP_SUBSIDIARY_KEY": "bigint",
        "SCND_SHIP_ITEM_KEY": "bigint",
        "FST_SHIP_ORDER_ID": "bigint",
        "SCND_SHIP_ORDER_ID": "bigint",
        "PRIMARY_PHONE_TYPE": "string",
        "ALT_PHONE1_NUMBER": "string",
        "ALT_PHONE1_TYPE": "string",
        "ALT_PHONE2_NUMBER": "string",
        "ALT_PHONE2_TYPE": "string",
        "FST_ORDER_ORDER_ID": "bigint",
        "GUEST_CODE": "string",
        "DIGITAL_CUSTOMER_ID": "string",
        "MARKET_PLACE_ID": "string",
        "MARKET_PLACE_CUST_ID": "string",
        "FST_SHIPPED_SHIP_DT": "timestamp",
        "PRIVACY_IND": "int",
    }
)
ADDRESS_SCHEMA = _schema(
    {
        "CUSTOMER_ADDRESS_KEY": "bigint",
        "CUSTOMER_KEY": "bigint",
        "CUSTOMER_ID": "bigint",
        "ADDR_NAME": "string",
        "ETL_SOURCE_SYSTEM": "string",
        "SOURCE_CREATE_DT": "timestamp",
        "ADDR_LINE1_TXT": "string",
        "ADDR_LINE2_TXT": "string",
        "CITY_NAME": "string",
        "STATE_CODE": "string",
        "COUNTRY_CODE": "string",
        "POSTAL_ZIP": "string",
        "POSTAL_ZIP4": "string",
        "ADDR_CLEANSING_IND": "int",
        "ADDR_FRAUD_IND": "int",
        "ADDR_QAS_VERIFIED_IND": "int",
        "ADDR_TYPE_CODE": "string",
        "SHIPTO_FIRST_NAME": "string",
        "SHIPTO_LAST_NAME": "string",
        "ETL_BEGIN_EFFECTIVE_DT": "timestamp",
        "ETL_END_EFFECTIVE_DT": "timestamp",
        "ETL_CURRENT_IND": "int",
        "ETL_VERSION_NBR": "int",
        "VOID_IND": "int",
        "UPD_BATCH_NBR": "bigint",
        "INS_BATCH_NBR": "bigint",
        "PRIVACY_IND": "int",
    }
)
ADDRESS_LAYOUT = Scd2Layout(
    natural_key=("CUSTOMER_ID", "ADDR_NAME", "ETL_SOURCE_SYSTEM"),
    content=(
        "SOURCE_CREATE_DT",
        "ADDR_LINE1_TXT",
        "ADDR_LINE2_TXT",
        "CITY_NAME",
        "STATE_CODE",
        "COUNTRY_CODE",
        "POSTAL_ZIP",
        "POSTAL_ZIP4",
        "ADDR_CLEANSING_IND",
        "ADDR_FRAUD_IND",
        "ADDR_QAS_VERIFIED_IND",
        "ADDR_TYPE_CODE",
        "SHIPTO_FIRST_NAME",
        "SHIPTO_LAST_NAME",
    ),
    surrogate="CUSTOMER_ADDRESS_KEY",
    parent="CUSTOMER_KEY",
    parent_id="CUSTOMER_ID",
    begin="ETL_BEGIN_EFFECTIVE_DT",
    end="ETL_END_EFFECTIVE_DT",
    current="ETL_CURRENT_IND",
    version="ETL_VERSION_NBR",
    void="VOID_IND",
    ins_batch="INS_BATCH_NBR",
    upd_batch="UPD_BATCH_NBR",
)
