"""Typed schemas, and the column names of the wide all-text export layout."""

from __future__ import annotations

from pyspark.sql import types as T

SLOTS = 12
MAX_FIELD_OCTETS = 500

# Filter types, kinds and the marker for "matched no account".
BATCH_TIMELINE = "BATCH_TIMELINE"
STREAM_TIMELINE = "STREAM_TIMELINE"
STREAM_REFERENCE = "STREAM_REFERENCE"
STREAM_TRACKER = "STREAM_TRACKER"
STREAM_KEYWORD = "STREAM_KEYWORD"
KIND_STATUS = "STATUS"
KIND_USER = "USER"
KIND_REJECTED_STATUS = "REJECTED-STATUS"
KIND_REJECTED_USER = "REJECTED-USER"
MODE_FORWARD = "FORWARD"
MODE_REVERSE = "REVERSE"

# Scalar columns of the wide status layout, in file order, each with the
# typed column it is made from.
STATUS_SCALARS = [
    ("statusFilterType", "filter_type"),
    ("statusOriginalUserFilter", "original_user"),
    ("statusDerivedUserFilter", "derived_user"),
    ("systemCreateDt", "system_create_ts"),
    ("statusId", "status_id"),
    ("statusUserId", "user_id"),
    ("statusCreatedAt", "created_at"),
    ("statusRefStatusId", "ref_status_id"),
    ("statusLang", "lang"),
    ("statusSource", "source"),
    ("statusText", "text"),
    ("statusFavoriteCount", "favorite_count"),
    ("statusRetweetCount", "retweet_count"),
    ("statusCurrentUserRetweetId", "current_user_retweet_id"),
    ("statusInReplyToUserId", "in_reply_to_user_id"),
    ("statusInReplyToStatusId", "in_reply_to_status_id"),
    ("statusIsReply", "is_reply"),
    ("statusInReplyToScreenName", "in_reply_to_screen_name"),
    ("statusIsFavorited", "is_favorited"),
    ("statusIsPossiblySensitive", "is_possibly_sensitive"),
    ("statusIsRetweet", "is_retweet"),
    ("statusIsRetweeted", "is_retweeted"),
    ("statusIsTruncated", "is_truncated"),
    ("statusRetweetedStatusId", "retweeted_status_id"),
    ("statusLatitude", "latitude"),
    ("statusLongitude", "longitude"),
    ("statusPlaceCountry", "place.country"),
    ("statusPlaceCountryCode", "place.country_code"),
    ("statusPlaceName", "place.name"),
    ("statusPlaceId", "place.id"),
    ("statusPlaceStreetAddress", "place.street_address"),
]

# Slot groups of the wide status layout, in file order.
STATUS_SLOT_GROUPS = [
    ("statusContributors", "contributors"),
    ("statusMediaEntities", "media_urls"),
    ("statusSymbolEntities", "symbols"),
    ("statusURLEntities", "urls"),
    ("statusUserMentionScreenName", "mentions.screen_name"),
    ("statusUserMentionId", "mentions.id"),
]
STATUS_HASHTAG = "statusHashtagEntity"

# Scalar columns of the wide user layout, in file order.
USER_SCALARS = [
    ("userFilterType", "filter_type"),
    ("userOriginalUserFilter", "original_user"),
    ("userDerivedUserFilter", "derived_user"),
    ("systemCreateDt", "system_create_ts"),
    ("userName", "name"),
    ("userId", "id"),
    ("userLocation", "location"),
    ("userCreatedAt", "created_at"),
    ("userLang", "lang"),
    ("userScreenName", "screen_name"),
    ("userTimeZone", "time_zone"),
    ("userURL", "url"),
    ("userFavouritesCount", "favourites_count"),
    ("userFollowersCount", "followers_count"),
    ("userFriendsCount", "friends_count"),
    ("userListedCount", "listed_count"),
    ("userStatusesCount", "statuses_count"),
    ("userUtcOffset", "utc_offset"),
    ("userProfileBannerIPadURL", "profile_banner_ipad_url"),
    ("userBiggerProfileImageURL", "bigger_profile_image_url"),
    ("userBiggerProfileImageURLHttps", "bigger_profile_image_url_https"),
    ("userDescription", "description"),
    ("userMiniProfileImageURL", "mini_profile_image_url"),
    ("userMiniProfileImageURLHttps", "mini_profile_image_url_https"),
    ("userOriginalProfileImageURL", "original_profile_image_url"),
    ("userOriginalProfileImageURLHttps", "original_profile_image_url_https"),
    ("userProfileBackgroundColor", "profile_background_color"),
    ("userProfileBackgroundImageURL", "profile_background_image_url"),
    ("userProfileBackgroundImageUrlHttps", "profile_background_image_url_https"),
    ("userProfileBannerIPadRetinaURL", "profile_banner_ipad_retina_url"),
    ("userProfileBannerMobileRetinaURL", "profile_banner_mobile_retina_url"),
    ("userProfileBannerMobileURL", "profile_banner_mobile_url"),
    ("userProfileBannerRetinaURL", "profile_banner_retina_url"),
    ("userProfileBannerURL", "profile_banner_url"),
    ("userProfileImageURL", "profile_image_url"),
    ("userProfileImageURLHttps", "profile_image_url_https"),
    ("userProfileLinkColor", "profile_link_color"),
    ("userProfileSidebarBorderColor", "profile_sidebar_border_color"),
    ("userProfileSidebarFillColor", "profile_sidebar_fill_color"),
    ("userProfileTextColor", "profile_text_color"),
    ("userURLEntity", "url_entity"),
]
USER_SLOT_GROUP = ("userDescriptionURLEntities", "description_urls")


def slot_names(prefix: str, slots: int = SLOTS) -> list[str]:
    return [f"{prefix}_{i}" for i in range(slots)]


def wide_status_columns() -> list[str]:
    slots = [name for prefix, _ in STATUS_SLOT_GROUPS for name in slot_names(prefix)]
    return [wide for wide, _ in STATUS_SCALARS] + slots + [STATUS_HASHTAG]


def wide_user_columns() -> list[str]:
    return [wide for wide, _ in USER_SCALARS] + slot_names(USER_SLOT_GROUP[0])


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


PLACE = "struct<country:string,country_code:string,name:string,id:string,street_address:string>"

STATUS_DDL = f"""
    filter_type string, original_user string, derived_user string, system_create_ts timestamp,
    status_id bigint, user_id bigint, created_at timestamp, ref_status_id bigint, lang string,
    source string, text string, favorite_count bigint, retweet_count bigint,
    current_user_retweet_id bigint, in_reply_to_user_id bigint, in_reply_to_status_id bigint,
    is_reply boolean, in_reply_to_screen_name string, is_favorited boolean,
    is_possibly_sensitive boolean, is_retweet boolean, is_retweeted boolean, is_truncated boolean,
    retweeted_status_id bigint, latitude double, longitude double, place {PLACE},
    contributors array<bigint>, media_urls array<string>, symbols array<string>,
    urls array<string>, mentions array<struct<screen_name:string,id:bigint>>,
    scope_place_ids array<string>, hashtags array<string>
"""

# Author record as landed: counts, offsets and 22 profile strings below one struct.
USER_FIELDS = [typed for _, typed in USER_SCALARS[4:]]
_USER_TYPES = {
    "id": "bigint", "created_at": "timestamp", "favourites_count": "bigint",
    "followers_count": "bigint", "friends_count": "bigint", "listed_count": "bigint",
    "statuses_count": "bigint", "utc_offset": "int",
}
LANDED_USER = "struct<{},description_urls:array<string>>".format(
    ",".join(f"{f}:{_USER_TYPES.get(f, 'string')}" for f in USER_FIELDS)
)

# Status record as landed (nested, one JSON object or Parquet row per status). A retweet carries the
# whole retweeted record; a record inside a record carries no further one.
_LANDED_FIELDS = {
    "id": "bigint", "created_at": "timestamp", "lang": "string", "source": "string", "text": "string",
    "favorite_count": "bigint", "retweet_count": "bigint", "current_user_retweet_id": "bigint",
    "in_reply_to_user_id": "bigint", "in_reply_to_status_id": "bigint",
    "in_reply_to_screen_name": "string", "favorited": "boolean", "possibly_sensitive": "boolean",
    "retweeted": "boolean", "truncated": "boolean",
    "geo": "struct<latitude:double,longitude:double>", "place": PLACE,
    "contributors": "array<bigint>", "media_urls": "array<string>", "symbols": "array<string>",
    "urls": "array<string>", "mentions": "array<struct<screen_name:string,id:bigint>>",
    "scopes": "struct<place_ids:array<string>>", "hashtags": "array<string>", "user": LANDED_USER,
}
EMBEDDED_STATUS = "struct<{}>".format(",".join(f"{n}:{t}" for n, t in _LANDED_FIELDS.items()))
LANDED_STATUS_DDL = ", ".join(
    f"{n} {t}" for n, t in [*_LANDED_FIELDS.items(), ("retweeted_status", EMBEDDED_STATUS)]
)

# Keys of a batch definition; every value is text.
BATCH_DEFINITION_KEYS = [
    "batchRunStartTime", "batchCutOffMaxDate", "batchName", "batchCutOffMinDate",
    "batchTrackStream", "userNames", "dateFormat", "batchRefLevel",
]
