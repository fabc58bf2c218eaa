"""Chat and multimodal message columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the system text of a reasoning prompt.
REASONING_SYSTEM_PROMPT = (
    "\nRespond in the following format:\n"
    "<reasoning>\n...\n</reasoning>\n"
    "<answer>\n...\n</answer>\n"
)

IMAGE_TYPE = (
    "struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
)


@dataclass(frozen=True)
class ChatLayout:
    """Text around each message; the defaults are the public ChatML layout."""

    open_role: str = "<|im_start|>"
    after_role: str = "\n"
    close_message: str = "<|im_end|>\n"
    image_marker: str = "<image>"


CHATML = ChatLayout()


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def build_chat_prompt(question: Column, system_prompt: str | None = None) -> Column:
    """System text and user question as an array of messages."""
    return F.array(
        message("system", F.lit(system_prompt or REASONING_SYSTEM_PROMPT)),
        message("user", question),
    )


def _generation_opening(layout: ChatLayout) -> str:
    return f"{layout.open_role}assistant{layout.after_role}"


def _render(messages: Column, content_of, add_generation_prompt: bool, layout: ChatLayout):
    rendered = F.transform(
        messages,
        lambda m: F.concat(
            F.lit(layout.open_role),
            m["role"],
            F.lit(layout.after_role),
            content_of(m["content"]),
            F.lit(layout.close_message),
        ),
    )
    text = F.array_join(rendered, "")
    if add_generation_prompt:
        text = F.concat(text, F.lit(_generation_opening(layout)))
    return text


def render_chat_text(
    messages: Column, add_generation_prompt: bool = False, layout: ChatLayout = CHATML
) -> Column:
    """Messages with plain text content as one string."""
    return _render(messages, lambda content: content, add_generation_prompt, layout)


def build_chat_text(
    user_text: Column, system_prompt: str | None = None, layout: ChatLayout = CHATML
) -> Column:
    """One user text rendered as a prompt that waits for the assistant."""
    return render_chat_text(build_chat_prompt(user_text, system_prompt), True, layout)


def text_part(text: Column) -> Column:
    return F.struct(
        F.lit("text").alias("type"),
        text.cast("string").alias("text"),
        F.lit(None).cast(IMAGE_TYPE).alias("image"),
    )


def image_part(image: Column | None = None) -> Column:
    image = F.lit(None).cast(IMAGE_TYPE) if image is None else image.cast(IMAGE_TYPE)
    return F.struct(
        F.lit("image").alias("type"),
        F.lit(None).cast("string").alias("text"),
        image.alias("image"),
    )


def build_vision_conversation(
    prompt: Column, response: Column, image: Column | None = None
) -> Column:
    """User message of text then image, assistant message of text."""
    return F.array(
        message("user", F.array(text_part(prompt), image_part(image))),
        message("assistant", F.array(text_part(response))),
    )


def build_vision_inference_messages(instruction: Column) -> Column:
    """User message of an image placeholder then the instruction text."""
    return F.array(message("user", F.array(image_part(), text_part(instruction))))


def render_vision_chat_text(
    messages: Column, add_generation_prompt: bool = True, layout: ChatLayout = CHATML
) -> Column:
    """Multimodal messages as one string with a marker at each image."""

    def content_of(parts: Column) -> Column:
        return F.array_join(
            F.transform(
                parts,
                lambda p: F.when(p["type"] == "image", F.lit(layout.image_marker)).otherwise(
                    p["text"]
                ),
            ),
            "",
        )

    return _render(messages, content_of, add_generation_prompt, layout)
