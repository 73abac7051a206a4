"""Column specifications of the two stage tables.

One list per table drives extraction, the exploded select, the DDL-like
schemas and the tests, so no column is written out by hand twice.

Column names follow one rule: ``<element>_<path with dots as underscores>``,
where the element is the flatten alias the value comes from (the session
document has no prefix).  The paths and types below are the fixed schema of
the session documents and must match it exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

STR = "string"
INT = "bigint"      # integers are 64-bit: revenue is held in micro-units
BOOL = "boolean"
VAR = "variant"
DATE = "date"


@dataclass(frozen=True)
class Column:
    name: str       # output column name
    element: str    # "" for the session document, else the flatten alias
    path: str       # dotted path inside the element ("" = the element itself)
    type: str

    @property
    def json_path(self) -> str:
        return "$" if not self.path else "$." + self.path


def _name(element: str, path: str) -> str:
    parts = [p for p in (element, path.replace(".", "_")) if p]
    return "_".join(parts)


def _cols(element: str, fields: list[tuple[str, str]]) -> list[Column]:
    return [Column(_name(element, p), element, p, t) for p, t in fields]


# --- Fixed values: session-document fields of the compact table, in table order.
SESSION_FIELDS: list[tuple[str, str]] = [
    ("clientId", STR), ("fullVisitorId", STR), ("visitorId", STR), ("userId", STR),
    ("visitNumber", INT), ("visitId", INT), ("visitStartTime", INT), ("date", DATE),
    ("totals", VAR),
    ("totals.bounces", INT), ("totals.hits", INT), ("totals.newVisits", INT),
    ("totals.pageviews", INT), ("totals.screenviews", INT), ("totals.sessionQualityDim", INT),
    ("totals.timeOnScreen", INT), ("totals.timeOnSite", INT),
    ("totals.totalTransactionRevenue", INT), ("totals.transactionRevenue", INT),
    ("totals.transactions", INT), ("totals.UniqueScreenViews", INT), ("totals.visits", INT),
    ("trafficSource", VAR),
    ("trafficSource.adContent", STR),
    ("trafficSource.adwordsClickInfo", VAR),
    ("trafficSource.adwordsClickInfo.adGroupId", INT),
    ("trafficSource.adwordsClickInfo.adNetworkType", STR),
    ("trafficSource.adwordsClickInfo.campaignId", INT),
    ("trafficSource.adwordsClickInfo.creativeId", INT),
    ("trafficSource.adwordsClickInfo.criteriaId", INT),
    ("trafficSource.adwordsClickInfo.criteriaParameters", STR),
    ("trafficSource.adwordsClickInfo.customerId", INT),
    ("trafficSource.adwordsClickInfo.gclId", STR),
    ("trafficSource.adwordsClickInfo.isVideoAd", BOOL),
    ("trafficSource.adwordsClickInfo.page", INT),
    ("trafficSource.adwordsClickInfo.slot", STR),
    ("trafficSource.adwordsClickInfo.targetingCriteria", VAR),
    ("trafficSource.adwordsClickInfo.targetingCriteria.boomUserlistId", INT),
    ("trafficSource.campaign", STR), ("trafficSource.campaignCode", STR),
    ("trafficSource.isTrueDirect", BOOL), ("trafficSource.keyword", STR),
    ("trafficSource.medium", STR), ("trafficSource.referralPath", STR),
    ("trafficSource.source", STR),
    ("socialEngagementType", STR), ("channelGrouping", STR),
    ("device", VAR),
    ("device.browser", STR), ("device.browserSize", STR), ("device.browserVersion", STR),
    ("device.deviceCategory", STR), ("device.mobileDeviceInfo", STR),
    ("device.mobileDeviceMarketingName", STR), ("device.mobileDeviceModel", STR),
    ("device.mobileInputSelector", STR), ("device.operatingSystem", STR),
    ("device.operatingSystemVersion", STR), ("device.isMobile", BOOL),
    ("device.mobileDeviceBranding", STR), ("device.flashVersion", STR),
    ("device.javaEnabled", BOOL), ("device.language", STR), ("device.screenColors", STR),
    ("device.screenResolution", STR),
    ("customDimensions", VAR),
    ("geoNetwork", VAR),
    ("geoNetwork.continent", STR), ("geoNetwork.subContinent", STR), ("geoNetwork.country", STR),
    ("geoNetwork.region", STR), ("geoNetwork.metro", STR), ("geoNetwork.city", STR),
    ("geoNetwork.cityId", STR), ("geoNetwork.latitude", STR), ("geoNetwork.longitude", STR),
    ("geoNetwork.networkDomain", STR), ("geoNetwork.networkLocation", STR),
    ("hits", VAR),
    ("privacy_info", VAR),
    ("privacy_info.ads_storage", STR), ("privacy_info.analytics_storage", STR),
    ("privacy_info.uses_transient_token", STR),
]

# --- Fixed values: element fields of the exploded table, in table order.
# Each entry is (flatten alias, path inside that element, type).
SESSION_DIMENSION_FIELDS: list[tuple[str, str, str]] = [
    ("customDimensions", "index", INT), ("customDimensions", "value", STR),
]

HIT_FIELDS: list[tuple[str, str, str]] = [
    ("hits", "time", INT), ("hits", "dataSource", STR), ("hits", "referrer", STR),
    ("hits", "type", STR),
    ("hits", "sourcePropertyInfo", VAR),
    ("hits", "sourcePropertyInfo.sourcePropertyDisplayName", STR),
    ("hits", "sourcePropertyInfo.sourcePropertyTrackingId", STR),
    ("hits", "eCommerceAction", VAR),
    ("hits", "eCommerceAction.action_type", STR), ("hits", "eCommerceAction.option", STR),
    ("hits", "eCommerceAction.step", INT),
    ("hits", "exceptionInfo", VAR),
    ("hits", "exceptionInfo.description", STR), ("hits", "exceptionInfo.isFatal", BOOL),
    ("hits", "exceptionInfo.exceptions", INT), ("hits", "exceptionInfo.fatalExceptions", INT),
    ("hits", "hitNumber", INT), ("hits", "hour", INT), ("hits", "isSecure", BOOL),
    ("hits", "isEntrance", BOOL), ("hits", "isExit", BOOL), ("hits", "isInteraction", BOOL),
    ("hits", "latencyTracking", VAR),
    ("hits", "latencyTracking.domainLookupTime", INT),
    ("hits", "latencyTracking.domContentLoadedTime", INT),
    ("hits", "latencyTracking.domInteractiveTime", INT),
    ("hits", "latencyTracking.domLatencyMetricsSample", INT),
    ("hits", "latencyTracking.pageDownloadTime", INT),
    ("hits", "latencyTracking.pageLoadSample", INT),
    ("hits", "latencyTracking.pageLoadTime", INT),
    ("hits", "latencyTracking.redirectionTime", INT),
    ("hits", "latencyTracking.serverConnectionTime", INT),
    ("hits", "latencyTracking.serverResponseTime", INT),
    ("hits", "latencyTracking.speedMetricsSample", INT),
    ("hits", "latencyTracking.userTimingCategory", STR),
    ("hits", "latencyTracking.userTimingLabel", STR),
    ("hits", "latencyTracking.userTimingSample", INT),
    ("hits", "latencyTracking.userTimingValue", INT),
    ("hits", "latencyTracking.userTimingVariable", STR),
    ("hits", "minute", INT),
    ("hits", "page", VAR),
    ("hits", "page.pagePath", STR), ("hits", "page.pagePathLevel1", STR),
    ("hits", "page.pagePathLevel2", STR), ("hits", "page.pagePathLevel3", STR),
    ("hits", "page.pagePathLevel4", STR), ("hits", "page.hostname", STR),
    ("hits", "page.pageTitle", STR), ("hits", "page.searchKeyword", STR),
    ("hits", "page.searchCategory", STR),
    ("hits", "transaction", VAR),
    ("hits", "transaction.transactionId", STR), ("hits", "transaction.transactionRevenue", INT),
    ("hits", "transaction.transactionTax", INT), ("hits", "transaction.transactionShipping", INT),
    ("hits", "transaction.affiliation", STR), ("hits", "transaction.currencyCode", STR),
    ("hits", "transaction.localTransactionRevenue", INT),
    ("hits", "transaction.localTransactionTax", INT),
    ("hits", "transaction.localTransactionShipping", INT),
    ("hits", "transaction.transactionCoupon", STR),
    ("hits", "item", VAR),
    ("hits", "item.transactionId", STR), ("hits", "item.productName", STR),
    ("hits", "item.productCategory", STR), ("hits", "item.productSku", STR),
    ("hits", "item.itemQuantity", INT), ("hits", "item.itemRevenue", INT),
    ("hits", "item.currencyCode", STR), ("hits", "item.localItemRevenue", INT),
    ("hits", "contentInfo", VAR),
    ("hits", "contentInfo.contentDescription", STR),
    ("hits", "appInfo", VAR),
    ("hits", "appInfo.appInstallerId", STR), ("hits", "appInfo.appName", STR),
    ("hits", "appInfo.appVersion", STR), ("hits", "appInfo.appId", STR),
    ("hits", "appInfo.screenName", STR), ("hits", "appInfo.landingScreenName", STR),
    ("hits", "appInfo.exitScreenName", STR), ("hits", "appInfo.screenDepth", STR),
    ("hits", "eventInfo", VAR),
    ("hits", "eventInfo.eventCategory", STR), ("hits", "eventInfo.eventAction", STR),
    ("hits", "eventInfo.eventLabel", STR), ("hits", "eventInfo.eventValue", INT),
    ("hits", "promotion", VAR),
    ("hits_promotion", "promoCreative", STR), ("hits_promotion", "promoId", STR),
    ("hits_promotion", "promoName", STR), ("hits_promotion", "promoPosition", STR),
    ("hits", "promotionActionInfo", VAR),
    ("hits", "promotionActionInfo.promoIsView", BOOL),
    ("hits", "promotionActionInfo.promoIsClick", BOOL),
    ("hits", "refund", VAR),
    ("hits", "refund.localRefundAmount", INT), ("hits", "refund.refundAmount", INT),
    ("hits", "experiment", VAR),
    ("hits_experiment", "experimentId", STR), ("hits_experiment", "experimentVariant", STR),
    ("hits", "publisher", VAR),
    ("hits", "publisher.adsenseBackfillDfpClicks", INT),
    ("hits", "publisher.adsenseBackfillDfpImpressions", INT),
    ("hits", "publisher.adsenseBackfillDfpMatchedQueries", INT),
    ("hits", "publisher.adsenseBackfillDfpMeasurableImpressions", INT),
    ("hits", "publisher.adsenseBackfillDfpPagesViewed", INT),
    ("hits", "publisher.adsenseBackfillDfpQueries", INT),
    ("hits", "publisher.adsenseBackfillDfpRevenueCpc", INT),
    ("hits", "publisher.adsenseBackfillDfpRevenueCpm", INT),
    ("hits", "publisher.adsenseBackfillDfpViewableImpressions", INT),
    ("hits", "publisher.adxBackfillDfpClicks", INT),
    ("hits", "publisher.adxBackfillDfpImpressions", INT),
    ("hits", "publisher.adxBackfillDfpMatchedQueries", INT),
    ("hits", "publisher.adxBackfillDfpMeasurableImpressions", INT),
    ("hits", "publisher.adxBackfillDfpPagesViewed", INT),
    ("hits", "publisher.adxBackfillDfpQueries", INT),
    ("hits", "publisher.adxBackfillDfpRevenueCpc", INT),
    ("hits", "publisher.adxBackfillDfpRevenueCpm", INT),
    ("hits", "publisher.adxBackfillDfpViewableImpressions", INT),
    ("hits", "publisher.dfpAdGroup", STR), ("hits", "publisher.dfpAdUnits", STR),
    ("hits", "publisher.dfpClicks", INT), ("hits", "publisher.dfpImpressions", INT),
    ("hits", "publisher.dfpMatchedQueries", INT),
    ("hits", "publisher.dfpMeasurableImpressions", INT),
    ("hits", "publisher.dfpNetworkId", STR), ("hits", "publisher.dfpPagesViewed", INT),
    ("hits", "publisher.dfpQueries", INT), ("hits", "publisher.dfpRevenueCpc", INT),
    ("hits", "publisher.dfpRevenueCpm", INT), ("hits", "publisher.dfpViewableImpressions", INT),
    ("hits", "customVariables", VAR),
    ("hits_customVariables", "index", INT), ("hits_customVariables", "customVarName", STR),
    ("hits_customVariables", "customVarValue", STR),
    ("hits", "customDimensions", VAR),
    ("hits_customDimensions", "index", INT), ("hits_customDimensions", "value", STR),
    ("hits", "customMetrics", VAR),
    ("hits_customMetrics", "index", INT), ("hits_customMetrics", "value", INT),
    ("hits", "social", VAR),
    ("hits", "social.hasSocialSourceReferral", STR),
    ("hits", "social.socialInteractionAction", STR),
    ("hits", "social.socialInteractionNetwork", STR),
    ("hits", "social.socialInteractionNetworkAction", STR),
    ("hits", "social.socialInteractions", INT),
    ("hits", "social.socialInteractionTarget", STR),
    ("hits", "social.socialNetwork", STR),
    ("hits", "social.uniqueSocialInteractions", INT),
    ("hits", "contentGroup", VAR),
    ("hits", "contentGroup.contentGroupUniqueViews2", STR),
    ("hits", "contentGroup.contentGroup1", STR), ("hits", "contentGroup.contentGroup2", STR),
    ("hits", "contentGroup.contentGroup3", STR), ("hits", "contentGroup.contentGroup4", STR),
    ("hits", "contentGroup.contentGroup5", STR),
    ("hits", "contentGroup.previousContentGroup1", STR),
    ("hits", "contentGroup.previousContentGroup2", STR),
    ("hits", "contentGroup.previousContentGroup3", STR),
    ("hits", "contentGroup.previousContentGroup4", STR),
    ("hits", "contentGroup.previousContentGroup5", STR),
    ("hits_product", "customDimensions", VAR),
    ("hits_product_customDimensions", "index", INT),
    ("hits_product_customDimensions", "value", STR),
    ("hits", "product", VAR),
    ("hits_product", "localProductPrice", INT), ("hits_product", "localProductRefundAmount", INT),
    ("hits_product", "localProductRevenue", INT), ("hits_product", "productBrand", STR),
    ("hits_product", "productPrice", INT), ("hits_product", "productQuantity", INT),
    ("hits_product", "productRefundAmount", INT), ("hits_product", "productRevenue", INT),
    ("hits_product", "productSKU", STR), ("hits_product", "productVariant", STR),
    ("hits_product", "v2ProductCategory", STR), ("hits_product", "v2ProductName", STR),
    ("hits_product", "isImpression", BOOL), ("hits_product", "isClick", BOOL),
    ("hits_product", "productListName", STR), ("hits_product", "productListPosition", INT),
]

# --- Fixed values: the flatten chain of the exploded table, in order.
# (alias, parent alias, path in parent, outer).  Only hits and promotions are inner.
FLATTEN_CHAIN: list[tuple[str, str, str, bool]] = [
    ("hits", "", "hits", False),
    ("hits_promotion", "hits", "promotion", False),
    ("hits_product", "hits", "product", True),
    ("customDimensions", "", "customDimensions", True),
    ("hits_experiment", "hits", "experiment", True),
    ("hits_customVariables", "hits", "customVariables", True),
    ("hits_customDimensions", "hits", "customDimensions", True),
    ("hits_customMetrics", "hits", "customMetrics", True),
    ("hits_product_customDimensions", "hits_product", "customDimensions", True),
    ("hits_product_customMetrics", "hits_product", "customMetrics", True),
]

HASH_COLUMN = "hash_id"
REQUIRED_KEYS = ("fullVisitorId", "visitId")
DEFAULT_MERGE_KEYS = ("visitId", "fullVisitorId", HASH_COLUMN)
DATE_FORMAT = "yyyyMMdd"

COMPACT: list[Column] = _cols("", SESSION_FIELDS)
COMPACT_NAMES: list[str] = [c.name for c in COMPACT] + [HASH_COLUMN]


def compact_types() -> dict[str, str]:
    out = {c.name: c.type for c in COMPACT}
    out[HASH_COLUMN] = STR
    return out


def _element_cols(fields: list[tuple[str, str, str]]) -> list[Column]:
    return [Column(_name(e, p), e, p, t) for e, p, t in fields]


def exploded_columns() -> list[Column]:
    """The 267 exploded columns, in table order.

    Rule: compact columns (without the hash) with the session custom
    dimension fields right after ``customDimensions``, and the hit blob plus
    all element fields at the end.
    """
    out: list[Column] = []
    for c in COMPACT:
        if c.name == "hits":
            continue
        out.append(c)
        if c.name == "customDimensions":
            out.extend(_element_cols(SESSION_DIMENSION_FIELDS))
    out.append(next(c for c in COMPACT if c.name == "hits"))
    out.extend(_element_cols(HIT_FIELDS))
    return out


EXPLODED: list[Column] = exploded_columns()
EXPLODED_NAMES: list[str] = [c.name for c in EXPLODED]
