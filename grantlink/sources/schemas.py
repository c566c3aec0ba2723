"""Schemas of the landed records, so that no reader infers any."""

_INSTITUTION = "struct<id:string,display_name:string,country_code:string,type:string>"
_LEVEL = "struct<id:string,display_name:string>"
_TOPIC = f"id:string,display_name:string,{{}}subfield:{_LEVEL},field:{_LEVEL},domain:{_LEVEL}"
_LINKS = "links struct<link:array<struct<href:string,rel:string>>>"

RAW_PROJECT = (
    "id string, title string, abstractText string, techAbstractText string, potentialImpact string, status string, grantCategory string, leadFunder string, leadOrganisationDepartment string, "
    "identifiers struct<identifier:array<struct<value:string,type:string>>>, researchSubjects struct<researchSubject:array<struct<id:string,text:string,percentage:double>>>, "
    "researchTopics struct<researchTopic:array<struct<id:string,text:string,percentage:double>>>, links struct<link:array<struct<href:string,rel:string,start:bigint,end:bigint>>>"
)
RAW_PERSON = f"id string, firstName string, surname string, otherNames string, email string, orcidId string, {_LINKS}"
RAW_PUBLICATION = f"id string, doi string, title string, chapterTitle string, type string, datePublished bigint, journalTitle string, publicationUrl string, author string, pubMedId string, isbn string, issn string, {_LINKS}"
RAW_ORGANISATION = f"id string, name string, addresses struct<address:array<struct<id:string,created:string,postCode:string,region:string,type:string>>>, {_LINKS}"
RAW_FUND = f"id string, valuePounds struct<amount:double>, {_LINKS}"
RAW_AUTHOR = (
    "id string, orcid string, display_name string, display_name_alternatives array<string>, works_count bigint, cited_by_count bigint, summary_stats struct<h_index:int,i10_index:int>, "
    f"affiliations array<struct<institution:{_INSTITUTION},years:array<int>>>, last_known_institutions array<{_INSTITUTION}>, topics array<struct<{_TOPIC.format('count:bigint,')}>>, "
    "counts_by_year array<struct<year:int,works_count:bigint,cited_by_count:bigint>>"
)
#: What the search by name added to an author.
MATCH_INFO = "gtr_author_name string, name_match_score double"
RAW_WORK = (
    "id string, doi string, title string, publication_date string, fwci double, cited_by_count bigint, "
    "authorships array<struct<author:struct<id:string>,institutions:array<struct<id:string,country_code:string>>,author_position:string>>, "
    f"topics array<struct<{_TOPIC.format('')}>>, referenced_works array<string>, ids struct<pmid:string,mag:string>, counts_by_year array<struct<year:int,cited_by_count:bigint>>"
)
RAW_INSTITUTION = "id string, associated_institutions array<struct<id:string,display_name:string,country_code:string,relationship:string>>"
SCHEMAS = {"project": RAW_PROJECT, "person": RAW_PERSON, "publication": RAW_PUBLICATION, "organisation": RAW_ORGANISATION, "fund": RAW_FUND, "author": RAW_AUTHOR, "matched_author": f"{RAW_AUTHOR}, {MATCH_INFO}", "work": RAW_WORK, "institution": RAW_INSTITUTION}
