"""Declared schemas of the engine's inputs."""

TEXT_FIELD = "struct<value:string,evidence:string>"
LIST_FIELD = "struct<value:array<string>,evidence:string>"

RECORD = (
    "struct<"
    f"nearest_locality:{TEXT_FIELD},administrative_unit:{TEXT_FIELD},excavation_type:{TEXT_FIELD},"
    f"geomorphic_position:{TEXT_FIELD},deposit_raw_terms:{LIST_FIELD},type_of_deposits:{LIST_FIELD},"
    "thickness:array<struct<kind:string,value_m:string,evidence:string>>,"
    f"absolute_elevation_m:{TEXT_FIELD},stratigraphic_position:{LIST_FIELD},dating_methods:{LIST_FIELD},"
    "source_kind:string>")
RESPONSE = f"struct<records:array<{RECORD}>>"

OCR_CHUNK = ("path string, page_from int, n_pages int, n_kept int, done_upto int, complete boolean, "
             "pages array<struct<idx:int,text:string>>, _corrupt_record string")
DOC_RESULT = ("path string, n_pages int, n_pages_extracted int, skipped_low_relevance boolean, n_records int, "
              f"n_sites int, tokens bigint, sec double, sites array<string>, records array<{RECORD}>, error string, "
              "_corrupt_record string")
JOB_STATUS = ("job_id string, filename string, status string, created bigint, queued bigint, updated bigint, "
              "msg string, n_proposals int, user string, source string, url string, journal string, year string, "
              "authors string")
PROPOSAL = ("struct<locality:string,admin:string,excavation:array<string>,geomorph:array<string>,"
            "deposits:array<string>,raw_terms:array<string>,thickness:array<string>,elevation:string,"
            "strat:array<string>,dating:array<string>,source_kinds:array<string>,evidence:array<string>,"
            "pages:array<int>,n_records:int,lat:double,lon:double,i:int,geo_note:string>")
DECISION = "struct<verdict:string,comment:string,user:string,ts:bigint>"
CORRECTION = "struct<field:string,verdict:string,comment:string,user:string,ts:bigint,movedFrom:string>"
PAGE_LINKS = "map<string,array<struct<src:string,pages:array<int>,approx:boolean>>>"
SCAN_INDEX = "map<string,map<string,string>>"
LINE_BOXES = "w int, h int, lines array<array<string>>, _corrupt_record string"
