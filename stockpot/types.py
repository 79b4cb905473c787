"""Schemas of documents; a key that a document lacks is null."""

DOCUMENT = (
    "schema_version int, id string, slug string, name string, recipe_type string, brief_description string, cuisine string, "
    "instructions array<struct<position:int,text:string>>, servings int, cooking_time_minutes int, preparation_time_minutes int, rest_time_minutes int, "
    "difficulty string, image_url string, video_url string, additional_media array<string>, nutritional_information map<string,string>, dietary_labels array<string>, "
    "allergens array<string>, equipment array<string>, "
    "ingredients array<struct<ingredient_id:string,name:string,normalized_name:string,quantity:string,unit:string,preparation:string,position:int>>, "
    "categories array<struct<id:string,slug:string,name:string>>, tags array<struct<id:string,slug:string,name:string,color:string>>, "
    "related_recipe_ids array<string>, recipe_notes array<string>, storage_notes array<string>, source struct<name:string,url:string>, public boolean, updated_at bigint, revision int"
)

#: The rows of index and review files by the key that holds them.
INDEXES = {
    "recipes": "id:string,slug:string,name:string,recipe_type:string,brief_description:string,cuisine:string,image_url:string,difficulty:string,servings:int,cooking_time_minutes:int,preparation_time_minutes:int,rest_time_minutes:int,total_time_minutes:int,"
    "category_slugs:array<string>,tag_slugs:array<string>,dietary_labels:array<string>,allergens:array<string>,ingredient_names:array<string>,instruction_step_count:int,updated_at:bigint,revision:int",
    "categories": "id:string,slug:string,name:string,description:string,recipe_count:bigint",
    "tags": "id:string,slug:string,name:string,color:string,recipe_count:bigint",
    "ingredients": "id:string,name:string,normalized_name:string,recipe_count:bigint",
    "entries": "recipe_id:string,recipe_slug:string,recipe_name:string,position:int,original_text:string,quantity:string,unit:string,cleaned_name:string,replacements:array<string>,issue_types:array<string>,resolution:string",
}
