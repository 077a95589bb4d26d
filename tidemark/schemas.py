"""Schemas of the nested documents (DDL strings, given to every JSON scan)."""

SOURCE = "struct<url:string,outlet:string,lang:string,tier:string,title:string>"

SCORE = (
    "struct<total:double,components:struct<impact:double,novelty:double,credibility:double,breadth:double,"
    "momentum:double>,coverage:int,mentions:int,baseline:double,verified:boolean>"
)

ITEM = (
    "struct<id:string,title:string,original_title:string,summary:string,why_it_matters:string,"
    "key_numbers:array<string>,topic:string,region:string,entities:array<string>,tickers:array<string>,"
    f"published_at:string,sources:array<{SOURCE}>,coverage:int,impact:double,novelty:double,"
    f"follow_up_of:string,confidence_note:string,score:{SCORE},placement:string,rank:int,quota:string>"
)

UPCOMING = "struct<date:string,title:string,kind:string,confidence:string,url:string>"

LEARN = (
    "struct<id:string,gap:string,title:string,item_ids:array<string>,why_today:string,explanation:string,"
    "math:string,python:string,minutes:int,refs:array<struct<url:string,title:string>>>"
)

THEME = "struct<title:string,summary:string,item_ids:array<string>>"

DAILY = (
    "date string, window struct<start:string,end:string>, tldr array<string>, "
    f"items array<{ITEM}>, upcoming array<{UPCOMING}>, learn array<{LEARN}>, notes string"
)

WEEKLY = (
    f"week string, headline string, themes array<{THEME}>, items array<{ITEM}>, "
    f"upcoming array<{UPCOMING}>, notes string"
)

PRICES = "symbol string, date date, close double"

SIGNALS = "struct<hf_upvotes:bigint,hn_points:bigint,hn_comments:bigint,hn_url:string>"

RAW_ITEM = (
    "id string, title string, url string, outlet string, feed string, tier string, lang string, "
    f"published_at timestamp, summary string, via string, signals {SIGNALS}"
)
