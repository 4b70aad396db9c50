"""Schemas of the tables that are read and written.  Text tables are read as strings, absent fields as empty ones."""

from __future__ import annotations

MANIFEST = (
    "filename string, url string, content_hash string, source string, subreddit string, post_id string, post_title string, flair string, timestamp string, "
    "status string, width string, height string, format string, file_size string, message_content string, is_upscaled string, post_date string"
)
METADATA = "filename string, source string, model_version string, width string, height string, format string, file_size string, url string, timestamp string"
SCORES = "file string, z_score string, is_fake string, raw_score string"
CAPTIONS = "map<string, struct<caption: string, should_reject: boolean, reject_signals: array<string>, error: string>>"
CLASSIFICATIONS = "map<string, string>"
#: One item of each source's listing pages, as ``from_json`` reads it.
LISTINGS = {
    "civitai": "id string, url string, name string, type string, mimeType string, postTitle string",
    "higgsfield": "id string, results struct<raw: struct<url: string, type: string>>, result struct<url: string, type: string>, params struct<prompt: string>",
    "reddit": "data struct<id: string, title: string, subreddit: string, link_flair_text: string, url: string, is_self: boolean, is_video: boolean, is_gallery: boolean, created_utc: double, media_metadata: map<string, struct<status: string, e: string, s: struct<u: string>>>, preview: struct<images: array<struct<source: struct<url: string>>>>>",
    "midjourney": "id string, content string, author struct<id: string>, attachments array<struct<url: string, filename: string, content_type: string>>, components array<struct<components: array<struct<custom_id: string>>>>",
    "tensorart": "id string, title string, content string, images array<struct<url: string, width: int, height: int, generationData: struct<type: string, tensorArtV1: struct<baseModel: struct<baseModel: string, label: string>, models: array<struct<type: string>>>>>>",
    "yodayo": "uuid string, photo_media array<struct<uuid: string, text_to_image: struct<model: string, prompt: string, extra_networks: array<string>>>>",
    "openart": "id string, prompt string, ai_model string, image struct<raw: string, raw_width: int, raw_height: int>, image_url string, image_width int, image_height int",
    "aigcarena": "EvalResourceId string, ModelName string, ModelVersionId string, PromptEn string, ModelImages array<struct<ImageUri: string, CompressionImageUri: string>>",
    "freepik": "id string, title string, download_url string, image struct<type: string, orientation: string, source: struct<url: string, size: string>>, author struct<name: string>, meta struct<published_at: string>",
    "grok_imagine": "id string, mediaType string, mediaUrl string, prompt string, modelName string, rRated boolean",
    "recraft": "image_id string, id string, prompt string, image_url string, model string, image_type string",
    "instagram": "url string, srcset string, w int, h int, username string",
    "twitter": "src string",
}
