"""Test data at scale: rows are functions of an id, so any number of tasks can make them.

A generator takes a frame with an id column, `spark.range(n)` or the keys of a table, and
adds columns by rule. Random-looking values come from `draw`, one salt per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.draws import draw, id_text
from tidemark.functions.watermarks import batch_key, moment

SECOND_DRAW = 1000
NULL_DRAW = 2000


@dataclass(frozen=True)
class Rule:
    """How a column is made. `null_of` (n, k): NULL for k in n draws."""

    name: str
    kind: str
    args: tuple = ()
    null_of: tuple[int, int] | None = None


def pick(name: str, *labels: str) -> Rule:
    return Rule(name, "pick", labels)


def flag(name: str, percent: int) -> Rule:
    return Rule(name, "flag", (percent,))


def money(name: str, below: int, growth: int = 0) -> Rule:
    """Hundredths below a limit, growing by so many percent per day."""
    return Rule(name, "money", (below, growth))


def exact(name: str) -> Rule:
    return Rule(name, "exact")


def ratio(name: str, below: int, divisor: int = 1, offset: int = 0) -> Rule:
    return Rule(name, "ratio", (below, divisor, offset))


def count(name: str, below: int, per_day: int = 0) -> Rule:
    return Rule(name, "count", (below, per_day))


def number(name: str, below: int, offset: int = 0, per_day: int = 0, null_of=None) -> Rule:
    return Rule(name, "number", (below, offset, per_day), null_of)


def text(name: str, before: str, below: int, after: str = "", width: int = 0, null_of=None) -> Rule:
    """A number between two texts, zero-padded to a width."""
    return Rule(name, "text", (before, below, after, width), null_of)


def by_day(name: str, labels: Sequence[str], other: str, below: int, width: int = 0) -> Rule:
    """A label per day of the initial load, another for later days, and a number."""
    return Rule(name, "by_day", (tuple(labels), other, below, width))


def days_away(name: str, within: int, sign: int = -1, null_of=None) -> Rule:
    return Rule(name, "days_away", (within, sign), null_of)


def rate(name: str, below: int, divisor: int, spark_type: str, offset: int = 0) -> Rule:
    return Rule(name, "rate", (below, divisor, spark_type, offset))


def exact_plus(name: str, below: int, fraction: str) -> Rule:
    """A whole number and a fixed fraction."""
    return Rule(name, "exact_plus", (below, fraction))


def days_off(name: str, days: int) -> Rule:
    """So many days from now."""
    return Rule(name, "days_off", (days,))


def constant(name: str, value: Any, spark_type: str = "string") -> Rule:
    return Rule(name, "constant", (value, spark_type))


# The reporting fact, column by column.
REPORTING_COLUMNS = (
    number("ClientID", 1000000, 0, 1000000),
    by_day("AccountNumber", ("DAY1-", "DAY2-", "DAY3-"), "NEXT-", 999999, 6),
    text("ClientCode", "CLI", 999999, "", 6),
    text("ExternalClientID", "EXT", 999999, "", 6),
    number("ParentClientID", 100000, null_of=(10, 3)),
    number("ClientTypeID", 50, 1),
    pick("RegionCode", "NAM", "EUR", "APJ", "LAM", "MEA"),
    pick("CountryCode", "US", "GB", "DE", "FR", "CA", "AU", "JP", "BR", "IN", "CN"),
    text("TerritoryCode", "TERR", 999),
    pick("SegmentCode", "Enterprise", "SMB", "Consumer", "Government", "Education"),
    money("Revenue", 10000000, 5),
    money("Cost", 8000000, 3),
    money("Profit", 2000000, 8),
    money("MarginAmount", 500000),
    money("TaxAmount", 1000000),
    money("DiscountAmount", 200000),
    money("CommissionAmount", 300000),
    money("BonusAmount", 100000),
    money("PenaltyAmount", 50000),
    money("AdjustmentAmount", 25000),
    exact("NetAmount"),
    exact("GrossAmount"),
    exact("CumulativeAmount"),
    exact("YearToDateAmount"),
    exact("LifetimeValue"),
    ratio("ConversionRate", 10000, 10000),
    ratio("ClickThroughRate", 10000, 10000),
    ratio("BounceRate", 10000, 10000),
    ratio("EngagementScore", 100),
    ratio("SatisfactionScore", 100),
    ratio("NpsScore", 100, 1, -50),
    ratio("ChurnProbability", 10000, 10000),
    ratio("RiskScore", 1000),
    ratio("QualityIndex", 100),
    ratio("PerformanceIndex", 100),
    count("TransactionCount", 0, 1000),
    count("OrderCount", 0, 500),
    count("ProductCount", 100),
    count("ServiceCount", 50),
    count("UserCount", 10000, 1000),
    count("SessionCount", 50000, 5000),
    count("ClickCount", 100000, 10000),
    count("ViewCount", 1000000, 100000),
    count("DownloadCount", 10000),
    count("ShareCount", 5000),
    count("CommentCount", 1000),
    count("LikeCount", 10000),
    count("FollowCount", 2000),
    count("ReferralCount", 500),
    count("ComplaintCount", 100),
    by_day("ClientName", ("Day1 Client ", "Day2 Client ", "Day3 Client "), "Incremental Client ", 99999),
    by_day("CompanyName", ("Day1 Business ", "Day2 Business ", "Day3 Business "), "Next Business ", 99999),
    pick(
        "Industry", "Technology", "Healthcare", "Finance", "Manufacturing", "Retail",
        "Education", "Government", "Energy", "Media", "Consulting",
    ),
    pick("Sector", "Software", "Hardware", "Services", "Products", "Consulting", "Support", "Training", "Research"),
    pick("BusinessType", "B2B", "B2C", "B2G", "Marketplace", "Platform"),
    text("ContactName", "Contact Person ", 9999),
    text("EmailAddress", "user", 999999, "@company.com"),
    text("PhoneNumber", "+1-555-", 10000, "", 4),
    text("Address1", "", 9999, " Main Street"),
    text("Address2", "Suite ", 999, null_of=(10, 7)),
    pick(
        "City", "New York", "Los Angeles", "Chicago", "Houston", "Phoenix",
        "Philadelphia", "San Antonio", "San Diego", "Dallas", "San Jose",
    ),
    pick("StateProvince", "NY", "CA", "IL", "TX", "AZ", "PA", "TX", "CA", "TX", "CA"),
    text("PostalCode", "", 99999, "", 5),
    text("Website", "https://www.company", 9999, ".com"),
    text("SocialMediaHandle", "@company", 9999),
    pick("PreferredLanguage", "English", "Spanish", "French", "German", "Mandarin"),
    pick("TimeZone", "UTC-8", "UTC-5", "UTC-0", "UTC+1", "UTC+8", "UTC+9", "UTC-3", "UTC+10"),
    pick("Currency", "USD", "EUR", "GBP", "JPY", "CAD"),
    pick("PaymentMethod", "Credit Card", "Bank Transfer", "PayPal", "Check", "Cash"),
    constant("Notes", None),
    flag("IsActive", 85),
    flag("IsVip", 15),
    flag("IsPremium", 25),
    flag("IsVerified", 70),
    flag("IsBlocked", 5),
    flag("IsDeleted", 3),
    flag("HasDiscount", 40),
    flag("HasLoyaltyCard", 60),
    flag("AcceptsMarketing", 75),
    flag("AcceptsEmails", 80),
    flag("AcceptsSms", 30),
    flag("AcceptsCalls", 20),
    flag("RequiresApproval", 10),
    flag("IsTestAccount", 2),
    flag("IsInternalAccount", 1),
    flag("HasApiAccess", 35),
    flag("HasMobileApp", 65),
    flag("HasWebAccess", 90),
    flag("RequiresTwoFactor", 45),
    flag("IsCompliant", 95),
    days_away("CreatedDate", 30),
    days_away("ModifiedDate", 7),
    days_away("LastLoginDate", 30, null_of=(10, 2)),
    days_away("LastPurchaseDate", 90, null_of=(10, 4)),
    days_away("LastContactDate", 60, null_of=(10, 3)),
    days_away("RegistrationDate", 1095),
    days_away("ExpiryDate", 365, 1, null_of=(10, 7)),
    days_away("RenewalDate", 365, 1, null_of=(10, 6)),
    days_away("SuspensionDate", 180, null_of=(100, 95)),
    days_away("ActivationDate", 1095),
    rate("DiscountRate", 5000, 10000, "decimal(10,4)"),
    rate("TaxRate", 2500, 10000, "decimal(10,4)"),
    rate("CommissionRate", 1500, 10000, "decimal(10,4)"),
    rate("InterestRate", 1000, 10000, "decimal(10,4)"),
    rate("InflationRate", 500, 10000, "decimal(10,4)"),
    rate("ExchangeRate", 200000, 100000, "decimal(15,6)", 50000),
    rate("GrowthRate", 5000, 10000, "decimal(8,4)", -2500),
    rate("RetentionRate", 10000, 100, "decimal(5,2)"),
    rate("MarginPercent", 10000, 100, "decimal(5,2)"),
    rate("CompletionPercent", 10000, 100, "decimal(5,2)"),
    pick("PriorityLevel", "Critical", "High", "Medium", "Low", "Info"),
    pick("StatusCode", "Active", "Pending", "Suspended", "Closed", "Review", "Expired"),
    text("CategoryCode", "CAT", 999, "", 3),
    text("SubCategoryCode", "SUB", 999, "", 3),
    text("ClassificationCode", "CLS", 99, "", 2),
)

# Columns of the reporting fact that its quick form makes another way.
QUICK_CHANGES = (
    constant("RegionCode", "NAM"),
    constant("CountryCode", "US"),
    constant("TerritoryCode", "TERR001"),
    constant("SegmentCode", "Enterprise"),
    money("Revenue", 100000),
    money("Cost", 80000),
    money("Profit", 20000),
    money("MarginAmount", 5000),
    money("TaxAmount", 10000),
    money("DiscountAmount", 2000),
    money("CommissionAmount", 3000),
    money("BonusAmount", 1000),
    money("PenaltyAmount", 500),
    money("AdjustmentAmount", 250),
    exact_plus("NetAmount", 999999, "0.123456789012345678"),
    exact_plus("GrossAmount", 999999, "0.234567890123456789"),
    exact_plus("CumulativeAmount", 999999, "0.345678901234567890"),
    exact_plus("YearToDateAmount", 999999, "0.456789012345678901"),
    exact_plus("LifetimeValue", 999999, "0.567890123456789012"),
    count("TransactionCount", 100),
    count("OrderCount", 50),
    count("ProductCount", 10),
    count("ServiceCount", 5),
    count("UserCount", 100),
    count("SessionCount", 500),
    count("ClickCount", 1000),
    count("ViewCount", 10000),
    count("DownloadCount", 100),
    count("ShareCount", 50),
    count("CommentCount", 10),
    count("LikeCount", 100),
    count("FollowCount", 20),
    count("ReferralCount", 5),
    count("ComplaintCount", 10),
    by_day("ClientName", ("Day1 Client ", "Day2 Client ", "Day3 Client "), "Incremental Client ", 999),
    by_day("CompanyName", ("Day1 Business ", "Day2 Business ", "Day3 Business "), "Next Business ", 999),
    constant("Industry", "Technology"),
    constant("Sector", "Software"),
    constant("BusinessType", "B2B"),
    text("ContactName", "Contact Person ", 99),
    constant("EmailAddress", "test@example.com"),
    constant("PhoneNumber", "+1-555-0199"),
    constant("Address1", "123 Test St"),
    constant("Address2", None),
    constant("City", "Test City"),
    constant("StateProvince", "CA"),
    constant("PostalCode", "12345"),
    constant("Website", "https://test.com"),
    constant("SocialMediaHandle", "@test"),
    constant("PreferredLanguage", "English"),
    constant("TimeZone", "UTC-8"),
    constant("Currency", "USD"),
    constant("PaymentMethod", "Credit Card"),
    constant("IsActive", True, "boolean"),
    constant("IsVip", False, "boolean"),
    constant("IsPremium", True, "boolean"),
    constant("IsVerified", True, "boolean"),
    constant("IsBlocked", False, "boolean"),
    constant("IsDeleted", False, "boolean"),
    constant("HasDiscount", True, "boolean"),
    constant("HasLoyaltyCard", True, "boolean"),
    constant("AcceptsMarketing", True, "boolean"),
    constant("AcceptsEmails", True, "boolean"),
    constant("AcceptsSms", False, "boolean"),
    constant("AcceptsCalls", False, "boolean"),
    constant("RequiresApproval", False, "boolean"),
    constant("IsTestAccount", False, "boolean"),
    constant("IsInternalAccount", False, "boolean"),
    constant("HasApiAccess", True, "boolean"),
    constant("HasMobileApp", True, "boolean"),
    constant("HasWebAccess", True, "boolean"),
    constant("RequiresTwoFactor", True, "boolean"),
    constant("IsCompliant", True, "boolean"),
    days_off("CreatedDate", 0),
    days_off("ModifiedDate", 0),
    constant("LastLoginDate", None, "timestamp_ntz"),
    constant("LastPurchaseDate", None, "timestamp_ntz"),
    constant("LastContactDate", None, "timestamp_ntz"),
    days_off("RegistrationDate", -30),
    constant("ExpiryDate", None, "timestamp_ntz"),
    constant("RenewalDate", None, "timestamp_ntz"),
    constant("SuspensionDate", None, "timestamp_ntz"),
    days_off("ActivationDate", 0),
    rate("ExchangeRate", 20000, 10000, "decimal(15,6)", 5000),
    rate("GrowthRate", 500, 1000, "decimal(8,4)", -250),
    constant("PriorityLevel", "High"),
    constant("StatusCode", "Active"),
)
_quick = {rule.name: rule for rule in QUICK_CHANGES}
QUICK_COLUMNS = tuple(_quick.get(rule.name, rule) for rule in REPORTING_COLUMNS)

# Attributes of the client dimension on its first day.
CLIENT_COLUMNS = (
    number("ClientID", 100000, 1000),
    text("ClientName", "Initial Client ", 999),
    text("CompanyName", "Company ", 999, " Inc"),
    pick("Industry", "Technology", "Healthcare", "Finance", "Manufacturing", "Retail"),
    pick("Sector", "Services", "Products", "Mixed"),
    pick("BusinessType", "B2B", "B2C", "B2G", "Mixed"),
    constant("ContactName", "John Doe"),
    constant("EmailAddress", "contact@company.com"),
    text("PhoneNumber", "+1-555-", 10000, "", 4),
    text("Address1", "", 9999, " Main St"),
    constant("City", "Initial City"),
    pick("StateProvince", "CA", "NY", "TX", "FL", "WA"),
    text("PostalCode", "", 100000, "", 5),
    constant("CountryCode", "US"),
    number("ClientTypeID", 10, 1),
    constant("RegionCode", "NAM"),
    text("TerritoryCode", "TERR", 10),
    pick("SegmentCode", "Enterprise", "SMB", "Startup"),
    pick("PriorityLevel", "High", "Medium", "Low"),
    constant("StatusCode", "Active"),
    constant("CategoryCode", "CAT_A"),
    constant("SubCategoryCode", "SUB_01"),
    constant("ClassificationCode", "CLS_1"),
    rate("CreditLimit", 100000, 1, "decimal(19,4)", 10000),
    constant("PaymentTerms", "Net 30"),
    rate("DiscountRate", 500, 10000, "decimal(5,4)"),
    constant("TaxRate", "0.0875", "decimal(5,4)"),
    constant("Currency", "USD"),
    constant("IsActive", True, "boolean"),
    constant("IsVip", False, "boolean"),
    constant("IsPremium", False, "boolean"),
    constant("IsVerified", True, "boolean"),
    constant("AcceptsMarketing", True, "boolean"),
    constant("RequiresApproval", False, "boolean"),
)

# Attributes of clients that appear on a later day.
NEW_CLIENT_COLUMNS = (
    number("ClientID", 100000, 0, 10000),
    Rule("ClientName", "text_of_day", ("New Client Day", " #", 999)),
    Rule("CompanyName", "text_of_day", ("NewCorp Day", " #", 999)),
    pick("Industry", "Technology", "Healthcare", "Finance", "Manufacturing", "Retail", "Energy"),
    pick("Sector", "Services", "Products", "Mixed"),
    constant("BusinessType", "B2B"),
    constant("ContactName", "New Contact"),
    constant("EmailAddress", "newcontact@newcorp.com"),
    text("PhoneNumber", "+1-555-", 10000, "", 4),
    text("Address1", "", 9999, " Innovation Blvd"),
    constant("City", "New City"),
    constant("StateProvince", "CA"),
    text("PostalCode", "", 100000, "", 5),
    constant("CountryCode", "US"),
    constant("ClientTypeID", 1, "int"),
    constant("RegionCode", "NAM"),
    constant("TerritoryCode", "TERR_NEW"),
    constant("SegmentCode", "Startup"),
    constant("PriorityLevel", "Medium"),
    constant("StatusCode", "New"),
    constant("CategoryCode", "CAT_NEW"),
    constant("SubCategoryCode", "SUB_NEW"),
    constant("ClassificationCode", "CLS_NEW"),
    constant("CreditLimit", 25000, "decimal(19,4)"),
    constant("PaymentTerms", "Net 15"),
    constant("DiscountRate", "0.0000", "decimal(5,4)"),
    constant("TaxRate", "0.0875", "decimal(5,4)"),
    constant("Currency", "USD"),
    constant("IsActive", True, "boolean"),
    constant("IsVip", False, "boolean"),
    constant("IsPremium", False, "boolean"),
    constant("IsVerified", False, "boolean"),
    constant("AcceptsMarketing", True, "boolean"),
    constant("RequiresApproval", True, "boolean"),
)


@dataclass(frozen=True)
class Change:
    """A change to one attribute in one of `odds` rows."""

    column: str
    odds: int
    kind: str
    args: tuple = ()


# How attributes of a client change, and how often.
CLIENT_CHANGES = (
    Change("ClientName", 10, "prefix", ("Updated ",)),
    Change("ContactName", 5, "value", ("Jane Smith", "string")),
    Change("EmailAddress", 8, "value", ("newemail@company.com", "string")),
    Change("PhoneNumber", 6, "made", (text("PhoneNumber", "+1-555-", 10000, "", 4),)),
    Change("SegmentCode", 15, "made", (pick("SegmentCode", "Enterprise", "SMB", "Startup"),)),
    Change("PriorityLevel", 12, "made", (pick("PriorityLevel", "High", "Medium", "Low"),)),
    Change("StatusCode", 20, "value", ("Premium", "string")),
    Change("CreditLimit", 10, "made", (rate("CreditLimit", 200000, 1, "decimal(19,4)", 20000),)),
    Change("DiscountRate", 15, "made", (rate("DiscountRate", 750, 10000, "decimal(5,4)"),)),
    Change("IsVip", 25, "value", (True, "boolean")),
    Change("IsPremium", 20, "value", (True, "boolean")),
)
CHANGED_SHARE_PERCENT = 25
CHANGE_SALT = 5000


def padded(value: Column, width: int) -> Column:
    """Zero-padded to a width; a longer number keeps all its digits."""
    digits = value.cast("string")
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, max(width, 1), "0"))


def business_key(id_column: Column, width: int = 4) -> Column:
    return F.concat(F.lit("CLIENT_"), padded(id_column, width))


def value_of(rule: Rule, key: str, salt: int, day: int, at: Column) -> Column:
    """Value of a rule for an id, a SQL text."""
    drawn = draw(key, salt)
    args = rule.args
    if rule.kind == "pick":
        value = F.element_at(F.array(*[F.lit(label) for label in args]), (drawn % len(args) + 1).cast("int"))
    elif rule.kind == "flag":
        value = drawn % 100 < args[0]
    elif rule.kind == "money":
        # Ten-thousandths: hundredths times a whole percentage.
        value = _scaled(drawn % args[0] * (100 + args[1] * day), 10000).cast("decimal(19,4)")
    elif rule.kind == "exact":
        millionths = _scaled(draw(key, salt + SECOND_DRAW) % 1000000, 1000000)
        value = ((drawn % 999999999).cast("decimal(10,0)") + millionths).cast("decimal(38,18)")
    elif rule.kind == "ratio":
        value = (drawn % args[0] + args[2]).cast("double") / F.lit(float(args[1]))
    elif rule.kind == "count":
        value = (drawn % (args[0] + args[1] * day)).cast("int")
    elif rule.kind == "number":
        value = (drawn % args[0] + (args[1] + args[2] * day)).cast("int")
    elif rule.kind == "text":
        before, below, after, width = args
        value = F.concat(F.lit(before), padded(drawn % below, width), F.lit(after))
    elif rule.kind == "by_day":
        labels, other, below, width = args
        value = F.concat(F.lit(labels[day - 1] if day <= len(labels) else other), padded(drawn % below, width))
    elif rule.kind == "text_of_day":
        value = F.concat(F.lit(f"{args[0]}{day}{args[1]}"), (drawn % args[2]).cast("string"))
    elif rule.kind == "days_away":
        value = F.timestamp_add("DAY", (drawn % args[0] * args[1]).cast("int"), at)
    elif rule.kind == "exact_plus":
        whole = (drawn % args[0]).cast("decimal(10,0)")
        value = (whole + F.lit(args[1]).cast("decimal(18,18)")).cast("decimal(38,18)")
    elif rule.kind == "days_off":
        value = F.timestamp_add("DAY", F.lit(args[0]), at)
    elif rule.kind == "rate":
        value = _scaled(drawn % args[0] + args[3], args[1]).cast(args[2])
    elif rule.kind == "constant":
        value = F.lit(args[0]).cast(args[1])
    else:
        raise ValueError(f"unknown rule {rule.kind!r}")
    if rule.null_of:
        of, nulls = rule.null_of
        value = F.when(draw(key, salt + NULL_DRAW) % of >= nulls, value)
    return value


def _scaled(whole: Column, divisor: int) -> Column:
    """A whole number of up to 14 digits divided by a power of ten, as an exact decimal."""
    return whole.cast("decimal(14,0)") * F.lit(Decimal(1) / Decimal(divisor))


def uuid_text(seed: Column) -> Column:
    """A repeatable identifier in uuid form."""
    digest = F.md5(seed.cast("string"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def spread(ids: DataFrame) -> DataFrame:
    """The ids dealt evenly to twice as many tasks as there are cores: a small file of ids, read by one task, becomes very
    many wide rows, whose making takes far longer than this shuffle of single columns."""
    return ids.repartition(2 * ids.sparkSession.sparkContext.defaultParallelism)


def generate_batch(
    ids: DataFrame, id_column: str, day: int, at: datetime | str, rules: Sequence[Rule] = REPORTING_COLUMNS
) -> DataFrame:
    """One fact row with all column families per id, for one day; amounts grow by day."""
    key, now = id_text(id_column), moment(at)
    made = [value_of(rule, key, 1 + place, day, now).alias(rule.name) for place, rule in enumerate(rules)]
    calendar = batch_key(now)
    batch_id = uuid_text(F.concat_ws("-", calendar, F.expr(key)))
    return spread(ids.select(id_column)).select(
        F.expr(key).alias("RecordID"), calendar.alias("SystemCalendarID"), batch_id.alias("BatchProcessID"), *made
    )


def generate_entities(
    ids: DataFrame, id_column: str, at: datetime | str, rules: Sequence[Rule] = CLIENT_COLUMNS
) -> DataFrame:
    """Clients of the first day, one per id."""
    key, now = id_text(id_column), moment(at)
    made = [value_of(rule, key, 1 + place, 1, now).alias(rule.name) for place, rule in enumerate(rules)]
    return ids.select(business_key(F.expr(key)).alias("ClientBusinessKey"), *made)


def generate_new_entities(
    ids: DataFrame, id_column: str, reserved_from: Column | int, day: int, at: datetime | str,
    rules: Sequence[Rule] = NEW_CLIENT_COLUMNS,
) -> DataFrame:
    """Clients that appear on a later day: one per id, keys counted up from a reserved number."""
    start = reserved_from if isinstance(reserved_from, Column) else F.lit(reserved_from)
    shifted = ids.select((F.col(id_column).cast("bigint") + start).alias("_key"))
    key, now = id_text("_key"), moment(at)
    made = [value_of(rule, key, 1 + place, day, now).alias(rule.name) for place, rule in enumerate(rules)]
    return shifted.select(business_key(F.col("_key")).alias("ClientBusinessKey"), *made)


def generate_changes(
    current: DataFrame,
    id_column: str,
    day: int,
    changes: Sequence[Change] = CLIENT_CHANGES,
    share: int = CHANGED_SHARE_PERCENT,
) -> DataFrame:
    """A share of the current entities, each attribute changed with its own odds. `id_column`
    is a number that is the entity's own; other days draw other entities."""
    key = id_text(id_column)
    salt = CHANGE_SALT + 100 * day
    replaced = {}
    for place, change in enumerate(changes, start=1):
        if change.kind == "prefix":
            new = F.concat(F.lit(change.args[0]), F.col(change.column))
        elif change.kind == "value":
            new = F.lit(change.args[0]).cast(change.args[1])
        else:
            new = value_of(change.args[0], key, salt + 50 + place, day, F.lit(None))
        hit = draw(key, salt + place) % change.odds == 0
        replaced[change.column] = F.when(hit, new).otherwise(F.col(change.column))
    return current.where(draw(key, salt) % 100 < share).withColumns(replaced)


def sample_rows(df: DataFrame, key: str, rows: int, seed: int = 0) -> DataFrame:
    """So many rows in random order of a numeric key; the same ones every time."""
    return df.orderBy(draw(id_text(key), seed), key).limit(rows)


def row_source(df: DataFrame, copies: Column | int, name: str = "copy") -> DataFrame:
    """Every row as many times as asked, numbered from 1; expanded in place, without a join."""
    times = copies.cast("int") if isinstance(copies, Column) else F.lit(copies)
    return df.where(times > 0).withColumn(name, F.explode(F.sequence(F.lit(1), times)))
